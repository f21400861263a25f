"""Keyed current-state table with field-level upserts (document ``$set`` semantics).

Fields that always come together form a *register*: a struct of the change's order
(``at``) and the fields' values.  The state of a register is its largest struct, so the
last change in the stated order wins whatever batch it came in; changes of equal order
are settled by their values.  Taking the largest does not mind order, grouping or
repetition: any cut of the same changes into batches, in any order of arrival and with
any replay, gives the same table.

* ``fold`` reduces changes to one row per key: the largest register among the changes in
  which its fields are present.  An explicit NULL is a value, an absent field is not.
  One aggregation, partial on the map side, so a hot key never gathers in one task.
* ``merge`` applies a folded batch to a folded state with one ``full_outer`` join.
* ``UpsertTable`` keeps the folded batches as layers (see ``layers``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paylake.operators.layers import Layers

REGISTER = "r_"


def registers(fields: list[str], presence: dict[str, str] | None = None) -> dict[str, list[str]]:
    """Register name to its fields: those that share a presence flag (or have none) share one."""
    out: dict[str | None, list[str]] = {}
    for f in fields:
        out.setdefault((presence or {}).get(f), []).append(f)
    return {REGISTER + group[0]: group for group in out.values()}


def _register(fields: list[str], order: list[str]) -> Column:
    return F.struct(F.struct(*order).alias("at"), *fields)


def fold(changes: DataFrame, key: str, fields: list[str], order: list[str],
         presence: dict[str, str] | None = None) -> DataFrame:
    """One row per key with a struct per register (NULL = never present).

    ``order`` columns give the order of changes within a key; ``presence`` maps
    a field to a boolean column telling whether the change carries it (fields
    not listed are always present).
    """
    rows = register_rows(changes, key, fields, order, presence)
    return rows.groupBy(key).agg(*[F.max(c).alias(c) for c in rows.columns if c != key])


def register_rows(changes: DataFrame, key: str, fields: list[str], order: list[str],
                  presence: dict[str, str] | None = None) -> DataFrame:
    """The changes as rows of registers, not folded yet."""
    out = []
    for name, group in registers(fields, presence).items():
        flag = (presence or {}).get(group[0])
        value = _register(group, order)
        out.append((F.when(F.col(flag), value) if flag else value).alias(name))
    return changes.select(key, *out)


def _fields(folded: DataFrame) -> dict[str, str]:
    """Field to the register that holds it."""
    return {f.name: c.name for c in folded.schema.fields if c.name.startswith(REGISTER) and isinstance(c.dataType, StructType)
            for f in c.dataType.fields[1:]}


def flatten(folded: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Plain rows of a folded state."""
    of = _fields(folded)
    return folded.select(key, *[(F.col(of[f])[f] if f in of else F.col(f)).alias(f) for f in fields])


def merge(state: DataFrame, folded: DataFrame, key: str, with_op: bool = False) -> DataFrame:
    """A folded batch merged into a folded state: per register the later change stays."""
    names = list(dict.fromkeys(_fields(folded).values()))
    o = state.select(F.col(key).alias("_ok"), F.struct(*names).alias("_o"))
    n = folded.select(F.col(key).alias("_nk"), F.struct(*names).alias("_n"))
    j = o.join(n, F.col("_ok").eqNullSafe(F.col("_nk")), "full_outer")  # a NULL key is one key
    cols = [F.coalesce("_ok", "_nk").alias(key)]
    cols += [F.greatest(F.col("_o")[c], F.col("_n")[c]).alias(c) for c in names]
    if with_op:
        cols.append(F.when(F.col("_o").isNull(), "insert").when(F.col("_n").isNull(), "keep")
                    .otherwise("update").alias("op"))
    return j.select(*cols)


class UpsertTable:
    """Current-state table under a shared folder; see the module's text.

    ``schema`` and ``order`` are DDL of the state columns and of the order columns.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, schema: str, order: str,
                 presence: dict[str, str] | None = None):
        self.key, self.presence = key, presence
        columns = StructType.fromDDL(schema)
        self.order = StructType.fromDDL(order)
        self.fields = [f.name for f in columns.fields if f.name != key]
        self._own = registers(self.fields, presence)
        layer = [columns[key]]
        stored = [columns[key], StructField("_at", self.order), StructField("_held", LongType())]
        for name, group in self._own.items():
            layer.append(StructField(name, StructType([StructField("at", self.order), *[columns[f] for f in group]])))
            stored += [StructField(f"_at_{name}", self.order), *[StructField(f"_f_{f}", columns[f].dataType) for f in group]]
        self.layers = Layers(spark, root, StructType(layer), [key], F.max, form=(StructType(stored), self._pack, self._unpack))

    def fold(self, changes: DataFrame) -> DataFrame:
        return fold(changes, self.key, self.fields, self.order.fieldNames(), self.presence)

    def register_rows(self, changes: DataFrame) -> DataFrame:
        return register_rows(changes, self.key, self.fields, self.order.fieldNames(), self.presence)

    def _pack(self, rows: DataFrame) -> DataFrame:
        """Rows of registers with each row's newest order once.

        Most registers of a row have that order, so only those that differ carry their own;
        ``_held`` has a bit for each register that is there.
        """
        names = self.layers.values
        orders = [F.col(c)["at"] for c in names]
        newest = F.greatest(*orders) if len(orders) > 1 else orders[0]
        held = sum((F.when(F.col(c).isNotNull(), 1 << i).otherwise(0).cast("long") for i, c in enumerate(names)), F.lit(0).cast("long"))
        return rows.select(self.key, newest.alias("_at"), held.alias("_held"), *[
            col for c, at in zip(names, orders, strict=True)
            for col in (F.when(at != newest, at).alias(f"_at_{c}"), *[F.col(c)[f].alias(f"_f_{f}") for f in self._own[c]])])

    def _unpack(self, packed: DataFrame) -> DataFrame:
        return packed.select(self.key, *[F.when(F.col("_held").bitwiseAND(F.lit(1 << i)) != 0, F.struct(
            F.coalesce(f"_at_{c}", "_at").alias("at"), *[F.col(f"_f_{f}").alias(f) for f in self._own[c]])).alias(c)
            for i, c in enumerate(self.layers.values)])

    def apply(self, folded: DataFrame, batch_id: int) -> None:
        """Add a folded batch as version ``batch_id``."""
        self.layers.apply(folded, batch_id)

    def read(self, before: int | None = None) -> DataFrame:
        return flatten(self.layers.read(before), self.key, self.fields)

    def beside(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """``(key, registers, _o)`` of the keys a batch touches, ahead of ``batch_id``.

        ``rows`` are the batch's rows of registers, folded or not.  They and the state's layers are
        folded together by one aggregation, so a row moves once; ``_o`` is NULL for a new key.
        """
        names, none = self.layers.values, F.lit(None)
        kinds = {f.name: f.dataType for f in self.layers.schema.fields}
        new = rows.select(self.key, *names, *[none.cast(kinds[c]).alias(f"_o_{c}") for c in names], F.lit(True).alias("_new"))
        old = self.layers._rows(self.layers.layers(batch_id)).select(
            self.key, *[none.cast(kinds[c]).alias(c) for c in names], *[F.col(c).alias(f"_o_{c}") for c in names],
            F.lit(False).alias("_new"))
        both = new.unionByName(old).groupBy(self.key).agg(
            *[F.max(c).alias(c) for c in (*names, *[f"_o_{c}" for c in names])],
            F.max("_new").alias("_touched"), F.min("_new").alias("_fresh"))  # a NULL key is one key
        before = F.when(~F.col("_fresh"), F.struct(*[F.col(f"_o_{c}").alias(c) for c in names]))
        return both.filter("_touched").select(self.key, *names, before.alias("_o"))

    def old_and_new(self, beside: DataFrame) -> DataFrame:
        """``(key, old, new)`` rows of ``beside``'s; ``old`` is NULL for a new key."""
        names, of = self.layers.values, _fields(beside)
        old = F.when(F.col("_o").isNotNull(), F.struct(*[F.col("_o")[of[f]][f].alias(f) for f in self.fields]))
        both = {c: F.greatest(F.col(c), F.col("_o")[c]) for c in names}
        new = F.struct(*[both[of[f]][f].alias(f) for f in self.fields])
        return beside.select(self.key, old.alias("old"), new.alias("new"))

    def changed(self, folded: DataFrame, batch_id: int) -> DataFrame:
        """``(key, old, new)`` rows of the keys a folded batch touches, ahead of ``batch_id``; ``old`` is NULL for a new key."""
        return self.old_and_new(self.beside(folded, batch_id))


def diff_as_of(changes: DataFrame, key: str, fields: list[str], order: list[str],
               presence: dict[str, str] | None, before, table_name: str) -> DataFrame:
    """Audit rows (INSERT / UPDATE) between the state of a change log at ``before`` and its latest state.

    Both states come from ONE aggregation over the log: every register is folded
    twice, once over the changes before the cut and once over all of them.
    No second pass and no join; a change log has no deletes.
    """
    early = before if not isinstance(before, (str, int, float)) else F.lit(before)
    aggs, old, new = [F.max(early).alias("_existed")], [], []
    for name, group in registers(fields, presence).items():
        flag = (presence or {}).get(group[0])
        present = F.col(flag) if flag else F.lit(True)
        aggs.append(F.max(F.when(present & early, _register(group, order))).alias(f"_o_{name}"))
        aggs.append(F.max(F.when(present, _register(group, order))).alias(f"_n_{name}"))
        old += [F.col(f"_o_{name}")[f].alias(f) for f in group]
        new += [F.col(f"_n_{name}")[f].alias(f) for f in group]
    folded = changes.groupBy(key).agg(*aggs)
    op = (F.when(~F.coalesce(F.col("_existed"), F.lit(False)), "INSERT")
          .when(~F.struct(*old).eqNullSafe(F.struct(*new)), "UPDATE"))
    return (folded.select(F.lit(table_name).alias("table_name"), op.alias("operation"), F.col(key).alias("record_id"))
            .filter(F.col("operation").isNotNull()))

"""Type-1 merge: update matched rows, insert new ones.

``scd1_merge`` returns the *whole* new target; nothing is written.
``scd1_touched`` gives the stored form: only the partitions that the batch
touches, read and returned as a whole.  Kept from the reference on purpose:

* no change detection: every staged match is re-stamped with the batch;
* lookup ids (and the surrogate id, create timestamps) are set on insert
  only, never refreshed by the update;
* the reports-to self lookup sees the table as it was before the insert;
* required lookups drop orphans, optional ones keep a NULL id.

Our one deliberate difference: a key staged twice is reduced to its latest
row (by update timestamp, then a row hash) before the merge; the reference
updates from an arbitrary one and inserts all copies.

Scale: the stage (one batch of changes) is usually far smaller than the
target.  When its bounded count allows, it is broadcast, so the target is
streamed once through a hash join and never shuffled; the matched keys for
the insert half come from a broadcast semi join.  Beyond the bound both
halves fall back to shuffle joins.  Every row of the result carries what
happened to it (``OP``), so counts rest on no clock value.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.batch import Batch
from nightshift.functions import changed
from nightshift.operators.joins import bounded_broadcast, fits, lookup
from nightshift.operators.surrogate import assign_surrogate_keys, max_id
from nightshift.schemas import Lookup, Scd1Spec
from nightshift.session import materialize

HIT = "__hit"
#: What the merge did with a row: 'u' (updated), 'i' (inserted) or null.
OP = "__op"


def _as(keys: list[str], prefix: str) -> list[Column]:
    return [F.col(k).alias(prefix + k) for k in keys]


def _same(keys: list[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with their prefixed copies."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def latest_per_key(stage: DataFrame, keys: list[str], ts: str = "update_timestamp") -> DataFrame:
    """One row per key: the latest by ``ts``, ties broken by a row hash.

    Keys are counted in hash aggregations over fixed-width values (partial on
    the map side, so a key repeated a million times is reduced before the
    shuffle).  Rows whose key occurs once, all rows of most batches, are
    neither shuffled nor sorted; only repeated keys meet their rows again.
    """
    others = [c for c in stage.columns if c not in keys]
    tagged = stage.withColumn("__hash", F.xxhash64(*others))
    sizes = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.max(ts).alias("__ts")).where("__n > 1")
    repeated = materialize(sizes.select(*_as(keys, "__k_"), "__ts"))
    if repeated.isEmpty():
        return stage
    held = bounded_broadcast(repeated)
    once = stage.join(held, _same(keys, "__k_"), "left_anti")
    rows = tagged.join(held, _same(keys, "__k_")).where(F.col(ts).eqNullSafe(F.col("__ts"))).select(*tagged.columns)
    best = materialize(rows.groupBy(*keys).agg(F.max("__hash").alias("__best")).select(*_as(keys, "__k_"), "__best"))
    picked = rows.join(bounded_broadcast(best), _same(keys, "__k_")).where("__hash = __best").select(*stage.columns)
    if not picked.groupBy(*keys).count().where("count > 1").isEmpty():
        # Rows that are equal in every column.
        picked = picked.dropDuplicates(keys)
    return once.unionByName(picked)


@dataclass
class Scd1Result:
    marked: DataFrame     # the new target with OP
    fresh: DataFrame      # inserted rows (target columns)
    matched: DataFrame    # keys of updated target rows

    @property
    def table(self) -> DataFrame:
        return self.marked.drop(OP)


def _renamed_stage(stage: DataFrame, spec: Scd1Spec) -> DataFrame:
    cols = [F.col(s).alias(t) for s, t in spec.keys]
    cols += [F.col(s).alias(t) for s, t in spec.attrs]
    cols += [F.col("create_timestamp"), F.col("update_timestamp")]
    return stage.select(*cols)


def _rename(spec: Scd1Spec, stage_col: str) -> str:
    for s, t in spec.keys + spec.attrs:
        if s == stage_col:
            return t
    return stage_col


def staged_rows(stage: DataFrame, spec: Scd1Spec) -> DataFrame:
    """The batch's stage, one row per key, computed once: both halves and the lookups read it."""
    return materialize(_renamed_stage(latest_per_key(stage, spec.stage_keys), spec))


def scd1_merge_parts(
    target: DataFrame,
    stage: DataFrame,
    spec: Scd1Spec,
    batch: Batch,
    parents: dict[str, DataFrame] | None = None,
    resolve_within_batch: bool = False,
    whole: DataFrame | None = None,
    staged: DataFrame | None = None,
    part: tuple[str, Column] | None = None,
) -> Scd1Result:
    """Update + insert halves of a type-1 merge (see the module docstring).

    ``target`` may be cut down to the partitions that hold all matches;
    ``whole`` is then the whole table (for new ids and the self lookup),
    ``staged`` the stage as ``staged_rows`` gives it, and ``part`` the
    partition column with its value for inserted rows.

    ``resolve_within_batch`` (off by default, as in the reference) lets a
    self lookup (reports-to) also find rows inserted by the same batch: it
    is then resolved after the new ids exist.
    """
    parents = parents or {}
    tkeys = spec.target_keys
    st = staged_rows(stage, spec) if staged is None else staged
    whole = target if whole is None else whole
    columns = [*spec.columns, *([part[0]] if part else [])]
    small = fits(st)

    # Update half: target LEFT JOIN stage on the natural key.
    upd = st.select(
        *tkeys,
        *[F.col(t).alias(f"__s_{t}") for _, t in spec.attrs],
        F.col("update_timestamp").alias("__s_upd"),
        F.lit(True).alias(HIT),
    )
    joined = target.join(F.broadcast(upd) if small else upd, tkeys, "left")
    hit = F.col(HIT).isNotNull()
    new_vals: dict[str, Column] = {t: F.when(hit, F.col(f"__s_{t}")).otherwise(F.col(t))
                                   for _, t in spec.attrs}
    new_vals["src_update_timestamp"] = F.when(hit, F.col("__s_upd")).otherwise(
        F.col("src_update_timestamp"))
    for name, value in batch.audit().items():
        new_vals[name] = F.when(hit, value).otherwise(F.col(name))
    updated = joined.select(*[new_vals.get(c, F.col(c)).alias(c) for c in columns], F.when(hit, F.lit("u")).alias(OP))

    # Insert half: stage rows whose key is not in the target (anti join).
    if small:
        matched = target.select(*tkeys).join(F.broadcast(st.select(*tkeys)), tkeys, "left_semi")
        # The new rows feed every lookup's map-side filter and the insert:
        # one scan of the target keys, not one per use.
        fresh = materialize(st.join(matched, tkeys, "left_anti"))
    else:
        matched = target.select(*tkeys).join(st.select(*tkeys), tkeys, "left_semi")
        fresh = st.join(target.select(*tkeys), tkeys, "left_anti")

    late = []
    base = fresh
    for lk in spec.lookups:
        if lk.self_ref and resolve_within_batch:
            late.append(lk)
            continue
        parent = whole if lk.self_ref else parents[lk.parent]
        fresh = lookup(fresh, parent, _rename(spec, lk.stage_col), lk.parent_key,
                       lk.parent_id, lk.target_col, lk.required, small_rows=small,
                       keys_from=base)
    if spec.surrogate:
        if small and base.isEmpty():
            # Nothing new this batch (common for slow dimensions): skip the
            # id assignment jobs.
            fresh = fresh.withColumn(spec.surrogate, F.lit(None).cast("bigint"))
        else:
            fresh = assign_surrogate_keys(fresh, tkeys, spec.surrogate,
                                          max_id(whole, spec.surrogate))
    for lk in late:
        # The table as it will be after the insert: old rows and new ids.
        ids = whole.select(lk.parent_key, lk.parent_id).unionByName(
            fresh.select(F.col(_rename(spec, lk.parent_key)).alias(lk.parent_key),
                         F.col(spec.surrogate).alias(lk.parent_id)))
        fresh = lookup(fresh, ids, _rename(spec, lk.stage_col), lk.parent_key,
                       lk.parent_id, lk.target_col, lk.required, small_rows=small)
    fresh = fresh.select(
        *[c for c in spec.columns if c in fresh.columns and c not in WAREHOUSE_STAMPS],
        F.col("create_timestamp").alias("src_create_timestamp"),
        F.col("update_timestamp").alias("src_update_timestamp"),
        batch.ts_col.alias("dw_create_timestamp"),
        *[v.alias(k) for k, v in batch.audit().items()],
        *([part[1].alias(part[0])] if part else []),
    ).select(*columns)
    return Scd1Result(updated.unionByName(fresh.withColumn(OP, F.lit("i"))), fresh, matched)


WAREHOUSE_STAMPS = {
    "src_create_timestamp", "src_update_timestamp", "dw_create_timestamp",
    "dw_update_timestamp", "etl_batch_no", "etl_batch_date",
}


@dataclass
class Touched:
    """The partitions of a type-1 table that a batch touches, as they will be."""

    marked: DataFrame                 # their whole new content with OP
    changes: DataFrame | None         # (id, old, new) of the tracked column, where it differs or is new
    parts: list                       # the partitions that were read


def in_parts(column: str, values: list) -> Column:
    """A filter on partition values, null among them."""
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def _values(df: DataFrame, column: Column) -> list:
    # Bounded by the number of partitions.
    return [r[0] for r in df.select(column.alias("v")).distinct().collect()]


def scd1_touched(
    whole: DataFrame,
    stage: DataFrame,
    spec: Scd1Spec,
    batch: Batch,
    part: str,
    parents: dict[str, DataFrame] | None = None,
    part_of: Column | None = None,
    part_from: Lookup | None = None,
    width: int | None = None,
    tracked: tuple[str, str] | None = None,
    resolve_within_batch: bool = False,
) -> Touched:
    """The merge of ``stage`` into the partitions of ``whole`` that it touches.

    ``part`` is the partition column.  An inserted row's partition is
    ``part_of`` its date, or that of its parent (``part_from``, a lookup), or the
    range of ``width`` ids that its new id lies in.  Stored rows stay where
    they are.  ``tracked`` (id, column) asks for the changes of that column.
    """
    st = staged_rows(stage, spec)
    keys = spec.target_keys
    if part_from is not None:
        # Rows without a parent are neither stored nor inserted.
        st = materialize(lookup(st, parents[part_from.parent], _rename(spec, part_from.stage_col), part_from.parent_key,
                                part_from.parent_id, part, part_from.required, small_rows=fits(st)))
        touched, value = _values(st, F.col(part)), F.col(part)
    else:
        met = whole.select(part, *keys).join(bounded_broadcast(st.select(*keys)), keys, "left_semi")
        # Bounded by the number of partitions.
        rows = {r[part]: r["count"] for r in met.groupBy(part).count().collect()}
        touched = list(rows)
        if part_of is not None:
            value = part_of
            touched += _values(st.join(met.select(*keys), keys, "left_anti"), value)
        else:
            value = F.floor(F.col(spec.surrogate) / F.lit(width)).cast("bigint")
            if sum(rows.values()) < st.count():
                touched.append((max_id(whole, spec.surrogate) + 1) // width)
    touched = list(dict.fromkeys(touched))
    target = whole.where(in_parts(part, touched))
    done = scd1_merge_parts(target, stage, spec, batch, parents, resolve_within_batch, whole=whole, staged=st, part=(part, value))
    changes = None
    if tracked:
        id_col, column = tracked
        new = st.select(*keys, F.col(column).alias("new"))
        met = target.select(*keys, id_col, F.col(column).alias("old")).join(bounded_broadcast(new), keys)
        changes = met.where(changed("new", "old")).select(id_col, "old", "new").unionByName(
            done.fresh.select(id_col, F.lit(None).cast(target.schema[column].dataType).alias("old"), F.col(column).alias("new")))
    return Touched(done.marked, changes, touched)


def scd1_merge(target, stage, spec, batch, parents=None) -> DataFrame:
    """The whole new target table after update + insert."""
    return scd1_merge_parts(target, stage, spec, batch, parents).table


def merge_counts(parts: Scd1Result, table_name: str) -> DataFrame:
    """(table_name, updated, inserted) as one row, without a collect."""
    tagged = parts.matched.select(F.lit("u").alias("__kind")).unionByName(
        parts.fresh.select(F.lit("i").alias("__kind"))
    )
    return tagged.agg(
        F.count_if(F.col("__kind") == "u").alias("updated"),
        F.count_if(F.col("__kind") == "i").alias("inserted"),
    ).select(F.lit(table_name).alias("table_name"), "updated", "inserted")

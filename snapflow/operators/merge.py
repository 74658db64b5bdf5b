"""Snapshot merge (M1-M9, F5, J2): fold one full snapshot into a long-lived table.

Every row of the result is one of

* **new**       key only in the snapshot: all insert columns, insert time, ``Active``/``New``;
* **updated**   key in both and the change predicate holds: update columns overwritten,
                modify time, counter + 1, ``Active``/``Updated``;
* **unchanged** key in both and nothing differs: target row passes through untouched;
* **dropped**   key only in the target: drop time, ``Inactive``/``Dropped`` (soft delete).

Plan shape: one full outer equi-join on the key (a sort-merge join that shuffles each side
once on the key) followed by a single projection of ``CASE`` expressions.  Keys are unique and
non-null on both sides (``guard_keys``), so no join key can be hot: the largest join group is
one row per side whatever the data volume.  The output is already hash-partitioned and sorted
by key, which is the layout the next run's join wants (K6).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
import operator

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Lifecycle labels written by the reference's MERGE statements.
ACTIVE = "Active"
INACTIVE = "Inactive"
NEW = "New"
UPDATED = "Updated"
DROPPED = "Dropped"

# per-run outcome of a row, before it is folded into the status columns
ACTION_INSERT, ACTION_UPDATE, ACTION_KEEP, ACTION_DROP, ACTION_GONE = (
    "insert", "update", "unchanged", "drop", "still_dropped")


@dataclass(frozen=True)
class MergeSpec:
    """Column roles of one snapshot-merge target.

    ``insert_cols``  source columns written when a key is new (target layout order);
    ``update_cols``  columns overwritten when a matched row changed (subset of insert_cols);
                     insert-only columns (M5) are those in insert_cols but not update_cols;
    ``compare_cols`` columns of the change predicate (F5), default = update_cols.
    """

    key: tuple[str, ...]
    insert_cols: tuple[str, ...]
    update_cols: tuple[str, ...]
    compare_cols: tuple[str, ...] | None = None
    status_col: str = "Status"
    substatus_col: str = "SubStatus"
    insert_time_col: str = "InsertDate"
    modify_time_col: str = "LastModifiedDate"
    drop_time_col: str = "DropDate"
    counter_col: str | None = "CountOfFiles"
    # "target": counter = target + 1 (files seen); "source": source + 1 (member-extract parity, Q1)
    counter_base: str = "target"
    # False = three-valued ``<>`` (NULL transitions are not a change), True = IS DISTINCT FROM
    null_safe: bool = False
    # Q11: a dropped key that re-appears counts as changed and its drop time is cleared
    reactivate: bool = True
    # Q12: False = drop time stamped on the first drop only; True = refreshed every run (parity)
    restamp_drops: bool = False
    surrogate_col: str | None = None
    surrogate_start: int = 10_000_000_000
    extra_cols: tuple[str, ...] = field(default_factory=tuple)
    # §1.4: text keys and text change columns compared under this collation (e.g.
    # "UTF8_LCASE_RTRIM": case and trailing blanks ignored, as SQL Server's usual default);
    # None = binary comparison
    collation: str | None = None

    @property
    def compare(self) -> tuple[str, ...]:
        return self.compare_cols if self.compare_cols is not None else self.update_cols

    def lifecycle_cols(self) -> list[str]:
        cols = []
        if self.counter_col:
            cols.append(self.counter_col)
        cols += [self.insert_time_col, self.modify_time_col, self.drop_time_col,
                 self.status_col, self.substatus_col]
        return cols

    def target_cols(self) -> list[str]:
        head = [self.surrogate_col] if self.surrogate_col else []
        return head + list(self.insert_cols) + self.lifecycle_cols()


def spec(key, insert_cols, update_cols, **kw) -> MergeSpec:
    """Convenience constructor accepting lists or a single key name."""
    key = (key,) if isinstance(key, str) else tuple(key)
    compare = kw.pop("compare_cols", None)
    return MergeSpec(key=key, insert_cols=tuple(insert_cols), update_cols=tuple(update_cols),
                     compare_cols=tuple(compare) if compare is not None else None, **kw)


def target_schema(ms: MergeSpec, source_schema: T.StructType) -> T.StructType:
    """Target layout: surrogate key, insert columns with the source types, lifecycle columns."""
    by_name = {f.name: f for f in source_schema.fields}
    fields = []
    if ms.surrogate_col:
        fields.append(T.StructField(ms.surrogate_col, T.LongType(), True))
    for c in ms.insert_cols:
        fields.append(T.StructField(c, by_name[c].dataType, True))
    for c in ms.lifecycle_cols():
        if c == ms.counter_col:
            dt = T.IntegerType()
        elif c in (ms.status_col, ms.substatus_col):
            dt = T.StringType()
        else:
            dt = T.TimestampNTZType()
        fields.append(T.StructField(c, dt, True))
    return T.StructType(fields)


def empty_target(spark, ms: MergeSpec, source_schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], target_schema(ms, source_schema))


def change_predicate(s: dict[str, Column], t: dict[str, Column], cols, null_safe: bool) -> Column:
    """OR over per-column inequality.  Three-valued by default: a NULL on either side is
    "unknown", which the MERGE treats as no change; ``null_safe`` uses IS DISTINCT FROM."""
    if not cols:
        return F.lit(False)
    if null_safe:
        terms = [~s[c].eqNullSafe(t[c]) for c in cols]
    else:
        terms = [s[c] != t[c] for c in cols]
    return F.coalesce(reduce(operator.or_, terms), F.lit(False))


def _ts(as_of) -> Column:
    return F.lit(as_of).cast(T.TimestampNTZType())


def snapshot_merge(target: DataFrame, source: DataFrame, ms: MergeSpec, as_of,
                   with_action: bool = False) -> DataFrame:
    """Merge one full snapshot ``source`` into ``target`` (both keyed by ``ms.key``).

    ``as_of`` replaces GETDATE() so reruns are deterministic.  ``with_action`` adds a
    ``merge_action`` column (insert / update / unchanged / drop / still_dropped) used by the
    reconciliation metrics.  Keys must already be unique and non-null: call ``guard_keys``.

    One full outer join.  Its output lies in no partitioning that Spark knows (the key is the
    target's or the source's), so a bucketed write would shuffle it: see ``merge_parts``.
    """
    s, t, cond = _sides(target, source, ms)
    return _outcome(t.join(s, cond, "full_outer"), source, ms, as_of, with_action, "either")


def merge_parts(target: DataFrame | None, source: DataFrame, ms: MergeSpec, as_of,
                with_action: bool = False) -> list[DataFrame]:
    """The rows of ``snapshot_merge`` in two frames: those of the target's keys and those of new keys.

    The first is the target left outer join the snapshot, the second the snapshot's keys that the
    target lacks; each keeps the hash partitioning of the side whose key it carries, so with two
    sides bucketed alike neither the joins nor a bucketed write move a row.  The target's key
    column is read twice.  Without a target all keys are new: one frame, no join."""
    first = target is None
    s, t, cond = _sides(empty_target(source.sparkSession, ms, source.schema) if first else target, source, ms)
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema.fields]
    if first:
        return [_outcome(s.select("*", *none), source, ms, as_of, with_action, "source")]
    kept = _outcome(t.join(s.hint("merge"), cond, "left_outer"), source, ms, as_of, with_action, "target")
    keys = t.select([f"t__{k}" for k in ms.key])
    new = s.hint("merge").join(keys, cond, "left_anti")
    return [kept, _outcome(new.select("*", *none), source, ms, as_of, with_action, "source")]


def _sides(target: DataFrame, source: DataFrame, ms: MergeSpec) -> tuple[DataFrame, DataFrame, Column]:
    """(source with columns ``s__*``, target with ``t__*``, join condition)."""
    src_names = set(source.columns)
    missing = [c for c in ms.insert_cols if c not in src_names]
    if missing:
        raise ValueError(f"source lacks insert columns {missing}")

    s_alias = {c: f"s__{c}" for c in ms.insert_cols}
    tgt_cols = ms.target_cols()
    t_alias = {c: f"t__{c}" for c in tgt_cols}
    s_cols = [F.col(f"`{c}`").alias(a) for c, a in s_alias.items()]
    if ms.counter_col and ms.counter_col in src_names and ms.counter_col not in s_alias:
        s_cols.append(F.col(f"`{ms.counter_col}`").alias("s__counter"))
    if ms.surrogate_col:
        if ms.surrogate_col not in src_names:
            raise ValueError(f"source lacks {ms.surrogate_col}: call keys.attach_surrogate first")
        s_cols.append(F.col(f"`{ms.surrogate_col}`").alias("s__surrogate"))
    s = source.select(s_cols)
    t = target.select([F.col(f"`{c}`").alias(a) for c, a in t_alias.items()])

    text = {f.name for f in source.schema.fields if isinstance(f.dataType, T.StringType)}

    def cmp(c: str, e: Column) -> Column:
        return F.collate(e, ms.collation) if ms.collation and c in text else e

    cond = reduce(operator.and_, [cmp(k, F.col(t_alias[k])) == cmp(k, F.col(s_alias[k]))
                                  for k in ms.key])
    return s, t, cond


def _outcome(j: DataFrame, source: DataFrame, ms: MergeSpec, as_of, with_action: bool, key_of: str) -> DataFrame:
    """Merged rows of joined sides.  ``key_of``: the side whose key a row has (``either``, ``target``, ``source``)."""
    ts = _ts(as_of)
    src_names = set(source.columns)
    tgt_cols = ms.target_cols()
    text = {f.name for f in source.schema.fields if isinstance(f.dataType, T.StringType)}

    def cmp(c: str, e: Column) -> Column:
        return F.collate(e, ms.collation) if ms.collation and c in text else e

    sc = {c: F.col(f"`s__{c}`") for c in ms.insert_cols}
    tc = {c: F.col(f"`t__{c}`") for c in tgt_cols}
    k0 = ms.key[0]
    in_t = tc[k0].isNotNull()
    in_s = sc[k0].isNotNull()
    is_new = ~in_t
    gone = ~in_s
    matched = in_t & in_s
    was_inactive = F.coalesce(tc[ms.status_col] == F.lit(INACTIVE), F.lit(False))
    compare = list(ms.compare)
    changed = matched & change_predicate({c: cmp(c, sc[c]) for c in compare},
                                         {c: cmp(c, tc[c]) for c in compare}, compare,
                                         ms.null_safe)
    if ms.reactivate:
        changed = changed | (matched & was_inactive)
    # evaluate the branch flags once per row; every output column then reads a boolean
    # instead of re-evaluating the (up to 117-term) change predicate
    j = j.select("*", is_new.alias("_is_new"), gone.alias("_gone"), changed.alias("_changed"),
                 was_inactive.alias("_was_inactive"))
    is_new, gone, changed, was_inactive = (F.col("_is_new"), F.col("_gone"), F.col("_changed"),
                                           F.col("_was_inactive"))

    out: list[Column] = []
    update = set(ms.update_cols)
    for c in ms.insert_cols:
        if c in ms.key:
            expr = {"either": F.coalesce(tc[c], sc[c]), "target": tc[c], "source": sc[c]}[key_of]
        elif c in update:
            expr = F.when(is_new | changed, sc[c]).otherwise(tc[c])
        else:  # insert-only (M5)
            expr = F.when(is_new, sc[c]).otherwise(tc[c])
        out.append(expr.alias(c))

    if ms.counter_col:
        # new rows start at the source's counter (1 when the source has none)
        src_counter = (F.col("s__counter") if ms.counter_col in src_names else F.lit(1))
        base = src_counter if ms.counter_base == "source" else tc[ms.counter_col]
        counter = (F.when(is_new, src_counter)
                   .when(changed, F.coalesce(base, F.lit(0)) + 1)
                   .otherwise(tc[ms.counter_col]))
        out.append(counter.cast(T.IntegerType()).alias(ms.counter_col))

    out.append(F.when(is_new, ts).otherwise(tc[ms.insert_time_col]).alias(ms.insert_time_col))
    out.append(F.when(changed, ts).otherwise(tc[ms.modify_time_col]).alias(ms.modify_time_col))
    if ms.restamp_drops:
        drop = F.when(gone, ts)
    else:
        drop = F.when(gone & ~was_inactive, ts).when(gone, tc[ms.drop_time_col])
    if ms.reactivate:
        drop = drop.when(changed, F.lit(None).cast(T.TimestampNTZType()))
    out.append(drop.otherwise(tc[ms.drop_time_col]).alias(ms.drop_time_col))
    out.append(F.when(is_new | changed, F.lit(ACTIVE)).when(gone, F.lit(INACTIVE))
               .otherwise(tc[ms.status_col]).alias(ms.status_col))
    out.append(F.when(is_new, F.lit(NEW)).when(changed, F.lit(UPDATED)).when(gone, F.lit(DROPPED))
               .otherwise(tc[ms.substatus_col]).alias(ms.substatus_col))
    action = (F.when(is_new, F.lit(ACTION_INSERT)).when(changed, F.lit(ACTION_UPDATE))
              .when(gone & was_inactive, F.lit(ACTION_GONE)).when(gone, F.lit(ACTION_DROP))
              .otherwise(F.lit(ACTION_KEEP)))
    out.append(action.alias("merge_action"))
    if ms.surrogate_col:
        # M7: issued before the merge by keys.attach_surrogate; never changes afterwards
        out.append(F.when(is_new, F.col("s__surrogate")).otherwise(tc[ms.surrogate_col])
                   .alias(ms.surrogate_col))

    merged = j.select(out)
    cols = tgt_cols + (["merge_action"] if with_action else [])
    return merged.select([F.col(f"`{c}`") for c in cols])


def merge_summary(table: DataFrame, ms: MergeSpec) -> DataFrame:
    """M9: rows per status / sub-status of the merged table."""
    return (table.groupBy(ms.status_col, ms.substatus_col)
            .agg(F.count(F.lit(1)).cast("long").alias("n_rows")))


def merge_into_table(spark, table, source: DataFrame, ms: MergeSpec, as_of,
                     on_duplicate: str = "error", order_by=None, audit: bool = True) -> dict:
    """Write-audit-publish merge of one snapshot into a ``sinks.VersionedTable``.

    0. the snapshot is written once to the shared checkpoint folder (lineage cut);
    1. M8 guard on the source key (``on_duplicate='first'`` keeps the first row per key under
       ``order_by`` instead of failing);  2. M7 identities for new keys;  3. the merge, with
       per-action row counts observed while the new version is written (no second scan);
    4. audit of the written version (key unique, row total = target + inserted);  5. publish.
    A failure before 5 leaves the published version untouched.
    """
    from snapflow.operators import checks
    from snapflow.operators.dedupe import top1_per_key
    from snapflow.operators.keys import attach_surrogate

    from snapflow.session import materialize, release

    key = list(ms.key)
    if on_duplicate == "first":
        source = top1_per_key(source, key, order_by or key, keyless="keep")
    # the snapshot is computed once (parsing, cleaning, conforming) and read back from the
    # shared checkpoint folder: the key guard and the identity step scan only its key column,
    # and a lost executor later in the run re-reads the copy instead of recomputing the feed.
    # With a bucketed target the copy is bucketed the same way (its one shuffle replaces the
    # guard's, the anti-join's and the merge join's)
    layout = table.layout() if hasattr(table, "layout") else None
    n = layout[1] if layout else getattr(table, "_buckets", None)
    # bucketed like the target: guard, identity anti-join and merge join need no exchange
    source = copy = materialize(source, "merge_source", bucket_by=(key, n) if n else None)
    checks.guard_keys(source, key, "source", collation=ms.collation)
    previous = table.read()
    if ms.surrogate_col:
        def issued():
            return previous.agg(F.max(ms.surrogate_col)).first()[0] if previous is not None else None

        claim = (lambda count: table.claim_ids(count, ms.surrogate_start, issued)) if hasattr(table, "claim_ids") else None
        source = attach_surrogate(source, previous, key[0], ms.surrogate_col, ms.surrogate_start,
                                  collation=ms.collation, claim=claim)
    # collated keys are joined under another hash than the buckets'
    clustered = bool(n) and not ms.collation
    if clustered:
        merged = merge_parts(previous, source, ms, as_of, with_action=True)
    else:
        target = previous if previous is not None else empty_target(spark, ms, source.schema)
        merged = [snapshot_merge(target, source, ms, as_of, with_action=True)]
    from pyspark.sql import Observation
    a = F.col("merge_action")
    observed = []
    for part in merged:
        obs = Observation(f"merge_{len(observed)}")
        observed.append((obs, part.observe(
            obs, F.count(F.lit(1)).alias("rows"),
            *[F.count_if(a == F.lit(x)).alias(x) for x in
              (ACTION_INSERT, ACTION_UPDATE, ACTION_KEEP, ACTION_DROP, ACTION_GONE)]).drop("merge_action")))
    version, path = table.write_next([part for _, part in observed], key, clustered=clustered)
    metrics = {}
    for obs, _ in observed:
        for name, value in obs.get.items():
            metrics[name] = metrics.get(name, 0) + value
    if audit:
        written = (table.read_version(version) if hasattr(table, "read_version")
                   else spark.read.parquet(path))
        bad = checks.key_violations(written, key).limit(5).collect()
        if bad:
            if hasattr(table, "drop_unpublished"):
                table.drop_unpublished()
            raise checks.DataCheckError(f"merged version {version} has duplicate keys {bad}")
        before = 0 if previous is None else previous.count()
        checks.reconcile(before + metrics[ACTION_INSERT], metrics["rows"], "merged rows")
    table.publish(version)
    # the published version no longer depends on the snapshot copy: drop it (a failed run
    # keeps its copy for inspection)
    release(copy)
    metrics["version"] = version
    return metrics

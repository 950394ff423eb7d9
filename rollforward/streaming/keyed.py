"""The versioned replay as a stream with keyed state: any rules, equal to the batch replay.

A later row may undo an earlier choice: it may come first in the rules' order, or be the second
copy that makes ``drop_all`` drop a row for good. So the state keeps what choices are made from:

- *moves*: a feed of the clean rows that each micro-batch adds and takes away. A row that is alone
  under its key is written there once and nowhere else, and is not moved for it;
- *rows*: of keys that have come again, every different row with the number of its copies;
- *winners*: of these keys the rows that are clean now, by entity;
- *rollup*: per entity and version the rollup of its clean rows.

The last three are tables in parts, cut by version and by a hash of the key or the entity. A
micro-batch first finds the keys that may have come before: only hashes of keys move for that. The
rows of these keys, those found in the moves included, are judged together. Rows that come are
then rolled up onto what their entities had; an entity that loses a row is rolled up anew. Parts of
versions that a batch has no rows of are not read; of the moves, a filter on the version leaves
out their row groups.

Each table carries the number of the last micro-batch that is part of it, in one step with its
rows. A repeated micro-batch skips the tables it has reached and goes on with the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.columns import quoted
from ..functions.conform import rename_cast
from ..operators.changes import row_states
from ..operators.first import by_heat, by_marks, keep_first, key_marks, repeated_marks, row_tie
from ..operators.quality import DROP_ALL, DUPLICATE_KEY, FULL_DUPLICATE, OFF, Rules, not_null, null_rejects
from ..operators.rollup import Rollup, newest_part, recombine, rollup_by_date, single_parts
from ..plans.ingest import Staging
from ..sources import parted
from ..sources.snapshots import COMPRESSION

COPIES, TIE = "_copies", "_tie"
INSERT, DELETE = "insert", "delete"
# In moves: the change, whether its key has come again, and the micro-batch.
CHANGE, AGAIN, BATCH = "_move", "_again", "_batch"


@dataclass(frozen=True)
class KeyedReplay:
    """One replay: catalog tables that start with ``name``, their files below ``out``.

    ``mapping`` types and renames the feed's columns and ``change_types`` picks its rows, as in
    the batch run. Rules hold within a version. ``parts`` is the number of parts of a version.
    """

    name: str
    out: str
    spec: Rollup
    rules: Rules
    version: str = "version"
    mapping: Mapping[str, tuple[str, str]] | None = None
    change_types: Iterable[str] | None = None
    parts: int = 8

    @property
    def tables(self) -> tuple[str, str, str, str]:
        return tuple(f"{self.name}_{t}" for t in ("rows", "moves", "winners", "rollup"))

    def start(
        self, spark: SparkSession, feed_dir: str, schema: StructType, *, files_per_batch: int | None = None
    ) -> StreamingQuery:
        """Process the files that are there and stop; a later start resumes."""
        reader = spark.readStream.schema(schema)
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return (
            reader.parquet(feed_dir)
            .writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", f"{self.out}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Bring the state up to a micro-batch; repeated, it changes nothing."""
        with Staging(batch.sparkSession) as staging:
            typed = rename_cast(row_states(batch, self.change_types), self.mapping or {})
            if self.version != parted.VERSION and parted.VERSION in typed.columns:
                raise ValueError(f"a column {parted.VERSION} beside the version column {self.version}")
            typed = typed.filter(quoted(self.version).isNotNull())
            null_rejects(typed, self.rules.required).write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{self.out}/rejects/batch={batch_id}")
            self._take_rows(staging, not_null(typed, self.rules.required), batch_id)
            self._take_moves(staging, typed.schema, batch_id)

    # ---- rows: what choices are made from ---------------------------------------------

    @property
    def _rules(self) -> Rules:
        return self.rules.within(self.version)

    def _take_rows(self, staging: Staging, rows: DataFrame, batch_id: int) -> None:
        spark, (table, moves_table, _, _) = rows.sparkSession, self.tables
        columns, key = rows.columns, list(self._rules.key)
        state = opened(spark, table, _counted_once(rows).schema, self.out, key, self.parts)
        if state.version >= batch_id:
            return
        versions = [r[0] for r in rows.select(quoted(self.version)).distinct().collect()]
        if not versions:
            return
        of_versions = quoted(self.version).isin(*versions)
        old = parted.in_parts(spark.table(table), [int(v) * self.parts + i for v in versions for i in range(self.parts)])
        known, moves = old.select(*[quoted(k) for k in key]), self._moves(spark)
        if moves is not None:
            moves = moves.filter(of_versions & ~F.col(AGAIN))
            known = known.unionByName(moves.filter(F.col(CHANGE) == INSERT).select(*[quoted(k) for k in key]))
        marks = staging.table(repeated_marks(rows, key, known), "marks")
        alone, again = by_marks(rows, key, marks)
        again = staging.table(again, "again")
        changes = [_moved(alone, columns, INSERT, False)]
        counted = staging.table(counted_rows(self._with_part(_counted_once(again), key), self._rules, columns), "counted")
        touched = [r[0] for r in counted.select(parted.PART).distinct().collect()]  # parts of the batch's versions
        attempt = parted.new_attempt(state)
        if touched:
            old = parted.in_parts(spark.table(table), touched)
            both = old.unionByName(counted)
            if moves is not None:
                # rows that were alone under their key until now
                met = self._alone(moves, columns, again, key)
                met = staging.table(self._with_part(_counted_once(met), key), "met")
                changes.append(_moved(met, columns, DELETE, False))
                both = both.unionByName(met)
            merged = staging.table(counted_rows(both, self._rules, columns), "merged")
            before, after = winners(old, self._rules), winners(merged, self._rules)
            parted.replace_partitions(merged, attempt)
            changes.append(_moved(_without(before, after, key), columns, DELETE, True))
            changes.append(_moved(_without(after, before, key), columns, INSERT, True))
        # in the feed a version is a micro-batch; the rows' own version stands beside it
        parted.write_changes(reduce(DataFrame.unionByName, changes).withColumnRenamed(self.version, "_of"), attempt)
        parted.publish(spark, table, attempt, state, moves_table, batch_id)

    # ---- winners and rollup -----------------------------------------------------------

    def _moves(self, spark: SparkSession) -> DataFrame | None:
        """All moves, the rows' version under its own name; None before the first."""
        if not spark.catalog.tableExists(self.tables[1]):
            return None
        return spark.table(self.tables[1]).withColumnRenamed(parted.VERSION, BATCH).withColumnRenamed("_of", self.version)

    def _alone(
        self, moves: DataFrame, columns: list[str], others: DataFrame | None = None, shared: Iterable[str] = ()
    ) -> DataFrame:
        """The rows that are alone under their key, or those of them that agree with ``others`` in ``shared``.

        A key that has come again once does not become alone again, so it is taken away once at most.
        """
        moves, key = moves.filter(~F.col(AGAIN)), self._rules.key
        found, gone = (moves.filter(F.col(CHANGE) == kind) for kind in (INSERT, DELETE))
        found = found.select(*[quoted(c) for c in columns])
        if others is not None:
            # bitmaps first, so that the joins get few rows
            near = by_marks(found, shared, key_marks(others, shared))[1]
            found = _joined(near, others.select(*[quoted(n) for n in shared]), shared, "left_semi")
        return _joined(found, gone.select(*[quoted(k) for k in key]), key, "left_anti")

    def _take_moves(self, staging: Staging, schema: StructType, batch_id: int) -> None:
        spark = staging.spark
        _, _, table, rollup_table = self.tables
        every = self._moves(spark)
        if every is None:
            return
        names, entity = [f.name for f in schema.fields], [self.version, *self.spec.keys]
        moves = every.filter(F.col(BATCH) == batch_id)
        changed = moves.filter(F.col(AGAIN)).select(*[quoted(n) for n in names], CHANGE)
        changed = changed.withColumn(TIE, F.xxhash64(*[quoted(n) for n in names]))
        changed = staging.table(self._with_part(changed, entity), "moves")
        touched = [r[0] for r in changed.select(parted.PART).distinct().collect()]
        shape = changed.select(*[quoted(n) for n in names], TIE).schema
        state = opened(spark, table, shape, self.out, self.spec.keys, self.parts)
        if touched and state.version < batch_id:
            old = parted.in_parts(spark.table(table), touched)
            gone = changed.filter(F.col(CHANGE) == DELETE)
            come = changed.filter(F.col(CHANGE) == INSERT).select(*old.columns)
            attempt = parted.new_attempt(state)
            parted.replace_partitions(_without(old, gone, self._rules.key).unionByName(come), attempt, touched)
            parted.publish(spark, table, attempt, state, None, batch_id)
        self._roll_up(staging, every, names, batch_id)

    def _roll_up(self, staging: Staging, every: DataFrame, names: list[str], batch_id: int) -> None:
        spark, spec, extra = staging.spark, self.spec, [self.version]
        _, _, table, rollup_table = self.tables
        entity = [self.version, *spec.keys]
        moves = every.filter(F.col(BATCH) == batch_id)
        dealt = self._with_part(moves.select(*[quoted(k) for k in entity]), entity)
        touched = [r[0] for r in dealt.select(parted.PART).distinct().collect()]
        if not touched:
            return
        come = moves.filter(F.col(CHANGE) == INSERT).select(*[quoted(n) for n in dict.fromkeys([*extra, *spec.inputs])])
        shape = rollup_by_date(come, spec, extra).select(self.version, *spec.outputs).schema
        state = opened(spark, rollup_table, shape, self.out, spec.keys, self.parts)
        if state.version >= batch_id:
            return
        # rows of an entity may meet in a task, unless it has very many
        rest, hot = by_heat(come, entity)
        parts = single_parts(rest, spec, extra).unionByName(rollup_by_date(hot, spec, extra))
        parts = parted.in_parts(spark.table(rollup_table), touched).drop(parted.PART).unionByName(parts)
        lost = moves.filter(F.col(CHANGE) == DELETE).select(*[quoted(k).alias(k) for k in entity]).distinct()
        lost = staging.table(lost, "lost")
        if not lost.isEmpty():
            others, near = by_marks(parts, entity, key_marks(lost, entity))
            again = _joined(parted.in_parts(spark.table(table), touched), lost, entity, "left_semi")
            again = again.select(*[quoted(n) for n in names]).unionByName(self._alone(every, names, lost, entity))
            parts = others.unionByName(_joined(near, lost, entity, "left_anti")).unionByName(rollup_by_date(again, spec, extra))
        parts = self._with_part(parts, entity).repartition(parted.PART)
        keys = [parted.PART, *extra]
        rolled = keep_first(recombine(parts, spec, keys), [*keys, *spec.keys], [F.col(spec.date_as).desc()])
        attempt = parted.new_attempt(state)
        rolled = rolled.select(self.version, *spec.outputs, parted.PART)
        parted.replace_partitions(rolled, attempt, touched, dealt=True)
        parted.publish(spark, rollup_table, attempt, state, None, batch_id)

    def _with_part(self, rows: DataFrame, keys: Iterable[str]) -> DataFrame:
        """A part per version and hash of the key; NULLs hash like any value."""
        hashed = F.pmod(F.xxhash64(*[quoted(k) for k in keys if k != self.version]), F.lit(self.parts))
        return rows.withColumn(parted.PART, (quoted(self.version) * self.parts + hashed).cast("int"))

    # ---- what can be read -------------------------------------------------------------

    def result(self, spark: SparkSession) -> DataFrame:
        """The rollup after the last micro-batch, with the version each row came from."""
        parts = spark.table(self.tables[3]).drop(parted.PART)
        return newest_part(parts, self.spec, [self.version]).select(self.version, *self.spec.outputs)

    def clean(self, spark: SparkSession) -> DataFrame:
        """The rows that are clean now."""
        found, moves = spark.table(self.tables[2]).drop(parted.PART, TIE), self._moves(spark)
        return self._alone(moves, found.columns).unionByName(found)

    def rejects(self, spark: SparkSession) -> DataFrame:
        """The rows that are set aside now, with ``reject_reason``.

        Copies come out as often as the batch rules reject them. If an identity stands
        for the row, copies show the other columns of the row that was kept.
        """
        rules, rows = self._rules, spark.table(self.tables[0])
        kept = winners(rows, rules).select(*[quoted(k) for k in rules.key], TIE).withColumn("_won", F.lit(True))
        marked = _joined(rows, kept, [*rules.key, TIE], "left").withColumn("_won", F.coalesce("_won", F.lit(False)))
        copies, won, n = F.col(COPIES), F.col("_won"), lambda c: F.greatest(c, F.lit(0)).cast("int")
        if rules.full_duplicates == DROP_ALL:
            again, others = F.when(copies > 1, F.lit(1)).otherwise(F.lit(0)), F.when((copies == 1) & ~won, F.lit(1))
        elif rules.full_duplicates == OFF:
            again, others = F.lit(0), copies - won.cast("int")
        else:
            again, others = copies - 1, F.when(~won, F.lit(1))
        times = lambda reason, k: F.array_repeat(F.lit(reason), n(F.coalesce(k, F.lit(0))))
        reasons = F.concat(times(FULL_DUPLICATE, again), times(DUPLICATE_KEY, others))
        derived = marked.withColumn("reject_reason", F.explode(reasons)).drop(COPIES, TIE, "_won", parted.PART)
        nulls = spark.read.parquet(f"{self.out}/rejects").drop("batch")
        return nulls.unionByName(derived)


def opened(
    spark: SparkSession, table: str, schema: StructType, out: str, keys: Iterable[str], parts: int
) -> parted.State:
    """The state of a table, made where it is missing, after what was left undone."""
    if not spark.catalog.tableExists(table):
        return parted.create_table(spark, table, schema, out, keys=keys, parts=parts)
    parted.settle(spark, table)
    return parted.state_of(spark, table)


def _counted_once(rows: DataFrame) -> DataFrame:
    return rows.withColumns({COPIES: F.lit(1).cast("long"), TIE: row_tie(rows)})


def _moved(rows: DataFrame, columns: list[str], kind: str, again: bool) -> DataFrame:
    return rows.select(*[quoted(c) for c in columns], F.lit(kind).alias(CHANGE), F.lit(again).alias(AGAIN))


def _order(rules: Rules) -> list[Column]:
    return [*[quoted(o) for o in rules.order], F.col(TIE)]


def counted_rows(rows: DataFrame, rules: Rules, columns: list[str]) -> DataFrame:
    """One row per key and identity, the first in the rules' order, with the number of copies."""
    identity = rules.row_identity(rows.select(*[quoted(c) for c in columns])) if rules.full_duplicates != OFF else columns
    groups = list(dict.fromkeys([*rules.key, *identity]))
    rest = [c for c in columns if c not in groups]
    first = F.min(F.struct(*_order(rules), *[quoted(c).alias(f"_r{i}") for i, c in enumerate(rest)]))
    grouped = rows.groupBy(parted.PART, *[quoted(c) for c in groups]).agg(F.sum(COPIES).alias(COPIES), first.alias("_first"))
    picked = {c: quoted(c) for c in groups} | {c: F.col("_first")[f"_r{i}"] for i, c in enumerate(rest)}
    return grouped.select(
        *[picked[c].alias(c) for c in columns], COPIES, F.col("_first")[TIE].alias(TIE), parted.PART
    )


def winners(counted: DataFrame, rules: Rules) -> DataFrame:
    """Per key the row to keep; Spark cuts the others before the exchange."""
    eligible = counted.filter(F.col(COPIES) == 1) if rules.full_duplicates == DROP_ALL else counted
    return keep_first(eligible, rules.key, _order(rules))


def _joined(left: DataFrame, right: DataFrame, names: Iterable[str], how: str) -> DataFrame:
    """A join on columns of which NULLs are equal."""
    names = list(names)
    renamed = right.select(
        *[quoted(n).alias(f"_j{i}") for i, n in enumerate(names)], *[quoted(c) for c in right.columns if c not in names]
    )
    same = reduce(and_, [quoted(n).eqNullSafe(F.col(f"_j{i}")) for i, n in enumerate(names)])
    return left.join(renamed, same, how).drop(*[f"_j{i}" for i in range(len(names))])


def _without(rows: DataFrame, others: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows of which ``others`` hold no row of that key and tie."""
    names = [*keys, TIE]
    found = _joined(rows, others.select(*[quoted(n) for n in names]), names, "left_anti")
    return found.select(*[quoted(c) for c in rows.columns])

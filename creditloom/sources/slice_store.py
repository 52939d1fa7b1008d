"""History on disk in slices of keys: a batch writes the slices it changes and no others.

A key's slice is a hash of it. Under a path, ``N`` being a batch and ``K`` a slice:

* ``current/batch=N/slice=K``: the current versions of a slice that batch N changed;
* ``closed/batch=N/slice=K``: the versions that batch N closed;
* ``whole/batch=N/slice=K``: all closed versions of a slice, where a late batch rewrote it;
* ``seen/batch=N/slice=K``: keys and hashes of the records that batch N delivered;
* ``changes/batch=N``: the versions that batch N opened and closed;
* ``batches/batch=N``: its moment and kind; written last.

The current versions as of a batch are the latest folder of each slice up to then. A batch of few
keys reads and writes their slices alone. Running a batch again replaces its folders. Folders
that no kept batch needs are deleted (:func:`expire`).
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.hashing import framed_md5
from creditloom.operators import history, timeline
from creditloom.operators.timeline import SEEN_AT
from creditloom.sources.schemas import as_before, reconcile
from creditloom.sources.staging import stage

ROWS_PER_SLICE = 500_000
MOST_SLICES = 4096
"""Slices of a history: one for so many records of its first batch, and no more than that."""
KEEP = 2
"""Batches whose state stays readable, the last one and the one before."""

_META = (
    "row_hash string, valid_from timestamp, valid_to timestamp, is_current boolean, "
    "is_deleted_in_source boolean, sk_id string"
)
_FOLDERS = (T.StructField("batch", T.IntegerType()), T.StructField("slice", T.IntegerType()))
_KINDS = ("current", "closed", "whole", "seen")
_SLICE = "_slice"


@dataclass(frozen=True)
class Sliced:
    """Folders ``kind/batch=N/slice=K`` under a path."""

    spark: SparkSession
    path: str

    def _names(self, pattern: str) -> list[str]:
        """Folders below the path that match, from a listing."""
        context = self.spark.sparkContext
        full = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        files = full.getFileSystem(context._jsc.hadoopConfiguration())
        found = files.globStatus(full) or []
        return [f.getPath().toString() for f in found]

    def _delete(self, names: Iterable[str]) -> None:
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def slices(self) -> int | None:
        """Number of slices, None before it was chosen."""
        names = self._names("slices=*")
        return int(names[0].rsplit("=", 1)[1]) if names else None

    def choose_slices(self, rows: int) -> int:
        """The number of slices; at first one for so many rows."""
        slices = self.slices()
        if slices is None:
            slices = max(1, min(MOST_SLICES, -(-rows // ROWS_PER_SLICE)))
            self.spark.range(0).write.parquet(f"{self.path}/slices={slices}")
        return slices

    def folders(self, kind: str) -> list[tuple[int, int]]:
        """(batch, slice) of all folders of a kind."""
        names = self._names(f"{kind}/batch=*/slice=*")
        parts = [n.rsplit("/", 2)[1:] for n in names]
        return sorted((int(b.split("=")[1]), int(s.split("=")[1])) for b, s in parts)

    def latest(self, kind: str, batch: int) -> dict[int, int]:
        """The last batch up to ``batch`` that wrote each slice."""
        return {s: b for b, s in self.folders(kind) if b <= batch}

    def _read_all(
        self, kind: str, schema: T.StructType, batch: int, only: Collection[int] | None
    ) -> DataFrame:
        """The folders of all batches up to one, with ``batch`` and ``slice``."""
        tagged = T.StructType([*schema.fields, *_FOLDERS])
        if not self._names(kind):
            return self.spark.createDataFrame([], tagged)
        reader = self.spark.read.schema(tagged).option("basePath", f"{self.path}/{kind}")
        rows = reader.parquet(f"{self.path}/{kind}").filter(F.col("batch") <= batch)
        return rows if only is None else rows.filter(F.col("slice").isin(list(only)))

    def _write(
        self, rows: DataFrame, kind: str, batch: int, marked: Collection[int] = ()
    ) -> None:
        """Write rows with their slice; ``marked`` slices get a folder even without rows."""
        if marked:
            marks = self.spark.createDataFrame([(s,) for s in marked], f"{_SLICE} int")
            rows = rows.unionByName(marks, allowMissingColumns=True)
        rows = rows.withColumnRenamed(_SLICE, "slice").hint("rebalance", "slice")
        rows.write.partitionBy("slice").parquet(f"{self.path}/{kind}/batch={batch}")


def slice_of(columns: Iterable[str], slices: int) -> Column:
    """The slice of a row, by a hash of some columns' text."""
    text = [F.col(c).cast("string") for c in columns]
    return F.pmod(F.xxhash64(*text), F.lit(slices)).cast("int")


@dataclass(frozen=True)
class Deliveries(Sliced):
    """All rows of a table that batches delivered, as they came, by the value of one column.

    For finding earlier rows with the values of a batch; slices without such values are not read.
    """

    column: str
    schema: T.StructType

    def add(self, batch: int, rows: DataFrame) -> None:
        """Keep the rows of a batch, or replace them; rows without a value cannot be met."""
        self._delete([f"rows/batch={batch}"])
        known = rows.select(*self.schema.names).filter(F.col(self.column).isNotNull())
        slices = self.slices() or self.choose_slices(known.count())
        self._write(known.withColumn(_SLICE, slice_of([self.column], slices)), "rows", batch)

    def met(self, batch: int, rows: DataFrame) -> DataFrame:
        """The rows of earlier batches that share their value with one of ``rows``; staged."""
        slices = self.slices()
        values = rows.select(self.column).filter(F.col(self.column).isNotNull()).distinct()
        if slices is None:
            return stage(self.spark.createDataFrame([], self.schema), "met-rows")
        values = stage(values.withColumn(_SLICE, slice_of([self.column], slices)), "values")
        past = self._read_all("rows", self.schema, batch - 1, _slices_in(values))
        shared = past.join(values.select(self.column), self.column, "left_semi")
        return stage(shared.select(*self.schema.names), "met-rows")


@dataclass(frozen=True)
class Store(Sliced):
    """A stored history: where it lies, the columns of its records, and its key."""

    record: str
    keys: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"{self.record}, {_META}")

    @property
    def seen_schema(self) -> T.StructType:
        kinds = T.StructType.fromDDL(self.record)
        fields = [kinds[k] for k in self.keys]
        fields += T.StructType.fromDDL(f"row_hash string, {SEEN_AT} timestamp").fields
        return T.StructType(fields)

    def batches(self) -> list[int]:
        return sorted(int(n.rsplit("=", 1)[1]) for n in self._names("batches/batch=*"))

    def last_batch(self) -> int | None:
        """Number of the last complete batch, None before the first."""
        return max(self.batches(), default=None)

    def moments(self, batch: int) -> list[tuple[str | None, bool, str, str]]:
        """Of each batch up to ``batch``: its last moment, whether it was a full snapshot, the
        columns of its records, and the watched ones."""
        at = [f"{self.path}/batches/batch={n}" for n in self.batches() if n <= batch]
        if not at:
            return []
        schema = "moment timestamp, full boolean, record string, watched string"
        rows = self.spark.read.schema(schema).parquet(*at)
        return [tuple(r) for r in rows.select(_text("moment"), "full", "record", "watched").collect()]

    def evolved(self, batch: int, arriving: T.StructType) -> Store:
        """The store for records that may have gained or widened columns since ``batch``.

        ValueError when a column has no type that holds old and new values.
        """
        record = T.StructType.fromDDL(self.record)
        for _, _, stored, _ in self.moments(batch):
            record = reconcile(T.StructType.fromDDL(stored), record)
        record = reconcile(record, arriving)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in record.fields)
        return replace(self, record=ddl)

    def _earlier_hashes(self, before: list[tuple], watched: list[str]) -> list[Column]:
        """Hashes of the incoming records as records of earlier batches were hashed."""
        now = T.StructType.fromDDL(self.record)
        hashes = []
        for record, names in sorted({(r, w) for _, _, r, w in before}):
            columns = names.split("\n")
            if (record, columns) == (self.record, watched):
                continue
            old = T.StructType.fromDDL(record)
            hashes.append(framed_md5([as_before(c, old[c].dataType, now[c].dataType) for c in columns]))
        return hashes

    # --- reading -------------------------------------------------------------------------

    def _read(self, kind: str, latest: dict[int, int]) -> DataFrame:
        """One folder for each slice, at most as many as there are slices."""
        paths = [f"{self.path}/{kind}/batch={b}/slice={s}" for s, b in sorted(latest.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read_current(self, batch: int, only: Collection[int] | None = None) -> DataFrame:
        """The current versions as of a batch; ``only`` of some slices."""
        latest = self.latest("current", batch)
        wanted = {s: b for s, b in latest.items() if only is None or s in only}
        # A slice that has lost its last record holds a row without values.
        return self._read("current", wanted).filter("is_current")

    def read_closed(self, batch: int, only: Collection[int] | None = None) -> DataFrame:
        """The versions closed up to a batch."""
        latest = self.latest("whole", batch)
        whole = {s: b for s, b in latest.items() if only is None or s in only}
        later = self._read_all("closed", self.schema, batch, only)
        if whole:
            since = F.create_map(*[F.lit(n) for pair in whole.items() for n in pair])
            later = later.filter(F.col("batch") > F.coalesce(since[F.col("slice")], F.lit(-1)))
        later = later.select(*self.schema.names)
        return later.unionByName(self._read("whole", whole).filter("sk_id is not null"))

    def read_history(self, batch: int, only: Collection[int] | None = None) -> DataFrame:
        """All versions as of a batch."""
        return self.read_current(batch, only).unionByName(self.read_closed(batch, only))

    def read_seen(self, batch: int, only: Collection[int] | None = None) -> DataFrame:
        """Keys, hashes and moments of all that was delivered up to a batch."""
        return self._read_all("seen", self.seen_schema, batch, only).drop("batch", "slice")

    def read_changes(self, batch: int) -> DataFrame:
        """The versions that one batch opened and closed, with ``change_type``."""
        schema = T.StructType([*self.schema.fields, T.StructField("change_type", T.StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/changes/batch={batch}")

    # --- writing -------------------------------------------------------------------------

    def _write(self, rows: DataFrame, kind: str, batch: int, marked: Sequence[int] = ()) -> None:
        """Write rows with ``_slice``; ``marked`` slices get a folder even without rows."""
        if marked:
            marks = self.spark.createDataFrame([(s,) for s in marked], f"{_SLICE} int")
            rows = rows.unionByName(marks, allowMissingColumns=True)
        (
            rows.withColumnRenamed(_SLICE, "slice")
            .hint("rebalance", "slice")
            .write.mode("overwrite")
            .partitionBy("slice")
            .parquet(f"{self.path}/{kind}/batch={batch}")
        )

    def apply(
        self,
        batch: int,
        incoming: DataFrame,
        as_of: str | datetime | None = None,
        at: str | None = None,
        tracked: Sequence[str] | None = None,
        held_keys: DataFrame | None = None,
        gone_keys: DataFrame | None = None,
        partial: bool = False,
        keep: int = KEEP,
    ) -> None:
        """Bring the history up to date with a batch.

        ``incoming`` is a full snapshot of the source at ``as_of``, or with ``partial`` records
        that are new or changed. Instead of ``as_of``, ``at`` may name a column of a partial batch
        with the moment of each record; a key may then come several times. A batch may lie
        before earlier ones: any order of the same batches gives the same history. ``held_keys``
        keep their version if a snapshot lacks them, and staged ``gone_keys`` are deleted by a
        partial batch that does not hold them; both are refused in a late batch.
        """
        if (at is None) == (as_of is None) or (at is not None and not partial):
            raise ValueError("give as_of, or for a partial batch at")
        self._delete([f"{k}/batch={batch}" for k in (*_KINDS, "changes", "batches")])
        given = [c for c in incoming.columns if c != at]
        watched = given if tracked is None else list(tracked)
        kinds = {f.name: f.dataType for f in self.schema.fields}
        incoming = incoming.withColumns({c: F.col(c).cast(kinds[c]) for c in given})
        moment = history.timestamp(as_of) if at is None else F.col(at)
        seen = timeline.observe(incoming, moment, watched).select(*given, "row_hash", SEEN_AT)
        seen = stage(seen, "arrived-records")
        slices = self.slices() or self.choose_slices(seen.count())
        seen = seen.withColumn(_SLICE, slice_of(self.keys, slices))
        only = None
        if partial:
            only = set(_slices_in(seen))
            if gone_keys is not None:
                only |= set(_slices_in(gone_keys.withColumn(_SLICE, slice_of(self.keys, slices))))
        before = self.moments(batch - 1)
        times = seen if at else self.spark.range(1).select(moment.alias(SEEN_AT))
        first, last = times.agg(_text(F.min(SEEN_AT)), _text(F.max(SEEN_AT))).first()
        latest = max((m for m, *_ in before if m), default=first)
        also = self._earlier_hashes(before, watched)
        self._write(seen.select(*self.keys, "row_hash", SEEN_AT, _SLICE), "seen", batch)
        if also and (at is not None or (first is not None and first < latest)):
            raise ValueError("after its columns changed, a history takes batches in order only")
        if first is not None and first < latest:
            if held_keys is not None or gone_keys is not None:
                raise ValueError("a late batch cannot hold or delete keys")
            moments = [m for m, full, *_ in before if full] + ([] if partial else [first])
            self._apply_late(batch, seen, only, moments, slices)
        elif at is not None:
            self._apply_chain(batch, seen, only, slices)
        elif not before:
            rows = history.initial(seen.drop("row_hash", SEEN_AT), self.keys, as_of, watched)
            self._write(rows.select(*self.schema.names, _SLICE), "current", batch)
        else:
            past = self.read_current(batch - 1, only)
            records = seen.drop("row_hash", SEEN_AT, _SLICE)
            changed = history.changes(
                past,
                records,
                self.keys,
                as_of,
                watched,
                held_keys=held_keys,
                partial=partial,
                also=also,
            )
            if gone_keys is not None:
                changed = changed.unionByName(
                    self._closed(past, records, gone_keys, as_of), allowMissingColumns=True
                )
            self._move(batch, past, changed, slices)
        end = F.lit(last).cast("timestamp").alias("moment")
        done = self.spark.range(1).select(
            end,
            F.lit(not partial).alias("full"),
            F.lit(self.record).alias("record"),
            F.lit("\n".join(watched)).alias("watched"),
        )
        done.write.parquet(f"{self.path}/batches/batch={batch}")
        self.expire(batch, keep)

    def _closed(
        self, past: DataFrame, records: DataFrame, gone: DataFrame, as_of: str | datetime
    ) -> DataFrame:
        """The current versions of keys that are gone and not among the records."""
        keys = list(self.keys)
        gone = gone.select(*keys).distinct().join(records.select(*keys), keys, "left_anti")
        facts = {
            "valid_to": history.timestamp(as_of),
            "is_current": F.lit(False),
            "is_deleted_in_source": F.lit(True),
            "change_type": F.lit(history.DELETE),
        }
        return past.join(gone, keys, "left_semi").withColumns(facts)

    def _apply_chain(
        self, batch: int, seen: DataFrame, only: Collection[int] | None, slices: int
    ) -> None:
        """Several versions of a key, none of them from before the last batch."""
        past = self.read_current(batch - 1, only)
        named = past.join(seen.select(*self.keys).distinct(), list(self.keys), "left_semi")
        columns = [*self._columns(), "row_hash", SEEN_AT]
        known = named.withColumn(SEEN_AT, F.col("valid_from")).select(*columns)
        chained = timeline.history_of(
            known.unionByName(seen.drop(_SLICE), allowMissingColumns=True), self.keys
        )
        self._move(batch, past, self._differences(named, chained), slices)

    def _apply_late(
        self,
        batch: int,
        seen: DataFrame,
        only: Collection[int] | None,
        moments: list[str],
        slices: int,
    ) -> None:
        """A batch between others: its slices follow from all that was ever seen of them."""
        past = stage(self.read_history(batch - 1, only), "history-before")
        columns = [*self._columns(), "row_hash"]
        values = past.select(*columns, F.col("valid_from").alias(SEEN_AT)).unionByName(
            seen.drop(_SLICE), allowMissingColumns=True
        )
        chained = timeline.chain(self.read_seen(batch, only), self.keys, moments)
        whole = timeline.with_values(chained, values, self.keys, SEEN_AT)
        whole = stage(
            whole.select(*self.schema.names).withColumn(_SLICE, slice_of(self.keys, slices)), "chained"
        )
        changed = self._differences(past, whole.drop(_SLICE))
        changed = stage(changed.withColumn(_SLICE, slice_of(self.keys, slices)), "changed")
        touched = _slices_in(changed)
        mine = whole.filter(F.col(_SLICE).isin(touched))
        self._write(mine.filter("is_current"), "current", batch, touched)
        self._write(mine.filter("not is_current"), "whole", batch, touched)
        changed.drop(_SLICE).write.parquet(f"{self.path}/changes/batch={batch}")

    def _columns(self) -> list[str]:
        return [c for c in self.schema.names if c not in history.META]

    def _differences(self, past: DataFrame, after: DataFrame) -> DataFrame:
        """The versions of ``after`` that ``past`` did not have like that, with ``change_type``."""
        keys = list(self.keys)
        name = [*keys, "row_hash", "valid_from", "valid_to", "is_current", "is_deleted_in_source"]
        same = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in name])
        fresh = after.alias("a").join(past.select(*name).alias("b"), same, "left_anti")
        had = past.select(*keys, F.lit(True).alias("_had")).distinct()
        kind = (
            F.when(~F.col("is_current") & F.col("is_deleted_in_source"), history.DELETE)
            .when(F.col("_had"), history.UPDATE)
            .otherwise(history.INSERT)
        )
        fresh = fresh.join(had, keys, "left").withColumn("change_type", kind)
        return fresh.select(*self.schema.names, "change_type")

    def _move(self, batch: int, past: DataFrame, changed: DataFrame, slices: int) -> None:
        """Write opened and closed versions, and the current slices that they belong to."""
        columns = self.schema.names
        changed = changed.select(*columns, "change_type").withColumn(_SLICE, slice_of(self.keys, slices))
        changed = stage(changed, "changed")
        touched = _slices_in(changed)
        self._write(changed.filter("not is_current").drop("change_type"), "closed", batch)
        rest = past.withColumn(_SLICE, slice_of(self.keys, slices)).filter(F.col(_SLICE).isin(touched))
        gone = changed.select(*self.keys).distinct()
        stay = rest.join(gone, list(self.keys), "left_anti").select(*columns, _SLICE)
        opened = changed.filter("is_current").drop("change_type")
        self._write(stay.unionByName(opened), "current", batch, touched)
        changed.drop(_SLICE).write.parquet(f"{self.path}/changes/batch={batch}")

    def expire(self, batch: int, keep: int = KEEP) -> None:
        """Delete current and rewritten slices that the last ``keep`` batches do not read."""
        for kind in ("current", "whole"):
            needed = self.latest(kind, batch - keep + 1)
            old = [(b, s) for b, s in self.folders(kind) if b < needed.get(s, -1)]
            self._delete([f"{kind}/batch={b}/slice={s}" for b, s in old])


def _text(moment: str | Column) -> Column:
    """A moment as text that sorts, in the session time zone."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _slices_in(rows: DataFrame) -> list[int]:
    """The slices that staged rows lie in, a bounded number."""
    return sorted(r[0] for r in rows.select(_SLICE).distinct().collect())

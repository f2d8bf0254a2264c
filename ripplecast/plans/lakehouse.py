"""Medallion layers as written Parquet tables under one root folder.

    <root>/landing                 JSON lines, one message per line, gzip files (the topic)
    <root>/_stage                  parsed messages by outcome (batch ingest)
    <root>/bronze                  valid, de-duplicated events (+ ingested_at)
    <root>/rejects                 rejected messages with failed rule names
    <root>/silver/user_dim         first-seen users
    <root>/silver/post_dim         first-seen posts
    <root>/silver/curated          enriched events, partitioned by event_date
    <root>/gold/<table>            gold tables

Every build overwrites its folder, so a rerun gives the same result (no
duplicated dimension rows). Writes are distributed; nothing passes through the
driver. Written layers are also the lineage cuts between stages.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ripplecast.constants import TRENDING_TOP_N, TRENDING_WINDOWS_MINUTES, VIRAL_LIKE_THRESHOLD, VIRAL_WINDOW_MINUTES
from ripplecast.functions.parsing import parse_messages
from ripplecast.operators import gold as G
from ripplecast.operators import silver as S
from ripplecast.operators.dedup import dedup_earliest
from ripplecast.functions.rules import failed_rules, is_valid, validation_rules
from ripplecast.operators.validate import rejected_events, typed_events, valid_events
from ripplecast.schema import BRONZE_COLUMNS, PARSED_COLUMNS
from ripplecast.session import session_time_zone

EVENT_DATE = "event_date"
GOLD_TABLES = ("trending_hashtags", "viral_posts", "influencer_ranking", "comment_sentiment")

STAGE_SCHEMA = (
    "value string, "
    + ", ".join(f"{c} string" for c in PARSED_COLUMNS)
    + ", failed_rules string, status string"
)

# Schemas of the date-partitioned layers: a partitioned write of no rows leaves
# no data file to infer a schema from, so these are read with their schema.
DATED_SCHEMAS: dict[tuple[str, ...], str] = {
    ("silver", "curated"): (
        "event_id string, event_type string, user_id string, username string, country string, "
        "target_user_id string, target_username string, post_id string, post_creator_user_id string, "
        "hashtag string, comment_text string, event_timestamp timestamp_ntz, event_date date"
    ),
    ("gold", "comment_sentiment"): (
        "event_id string, post_id string, user_id string, comment_text string, sentiment string, "
        "event_timestamp timestamp_ntz, calculated_at timestamp_ntz, event_date date"
    ),
    ("gold", "_creator_daily"): (
        "user_id string, like_count bigint, comment_count bigint, share_count bigint, event_date date"
    ),
}


def _hadoop_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A folder written by a committed Spark job carries `_SUCCESS`."""
    return _hadoop_exists(spark, path.rstrip("/") + "/_SUCCESS")


def write_messages(messages: DataFrame, path: str) -> None:
    """Messages as lines of compressed text files: JSON repeats its keys in every line, so the plain text is
    several times as long. A file is read by one task, so callers lay out files of a task's size."""
    messages.write.mode("overwrite").text(path, compression="gzip")


@dataclass
class GoldParams:
    trending_windows_minutes: tuple[int, ...] = TRENDING_WINDOWS_MINUTES
    trending_top_n: int = TRENDING_TOP_N
    viral_window_minutes: int = VIRAL_WINDOW_MINUTES
    viral_threshold: int = VIRAL_LIKE_THRESHOLD
    run_ts: object = None


@dataclass
class Lakehouse:
    spark: SparkSession
    root: str
    gold_params: GoldParams = field(default_factory=GoldParams)
    # Read DataFrames per layer folder: the file index (listing + footer
    # schema) is built once per session, dropped when the layer is rebuilt.
    _reads: dict = field(default_factory=dict, repr=False)
    _ensured: set = field(default_factory=set, repr=False)

    def _read(self, kind: str, *parts: str) -> DataFrame:
        key = (kind, parts)
        if key not in self._reads:
            path = self.path(*parts)
            if kind == "text":
                df = self.spark.read.text(path)
            elif kind == "batches":
                # Written by the streaming sink (query_id=/batch_id= folders):
                # only committed micro-batches; else a plain batch-written folder.
                from ripplecast.streaming.ingest import committed_batches

                batches = committed_batches(self.spark, path)
                df = (
                    self.spark.read.option("basePath", path).parquet(*batches)
                    if batches
                    else self.spark.read.parquet(path)
                )
            elif parts in DATED_SCHEMAS:
                df = self.spark.read.schema(DATED_SCHEMAS[parts]).parquet(path)
            else:
                df = self.spark.read.parquet(path)
            self._reads[key] = df
        return self._reads[key]

    def _invalidate(self, *prefixes: str) -> None:
        for key in [k for k in self._reads if k[1] and k[1][0] in prefixes]:
            del self._reads[key]
        self._ensured.clear()

    # ---------------------------------------------------------------- paths
    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def tz(self) -> str:
        return session_time_zone(self.spark)

    # ------------------------------------------------------------- landing
    def write_landing(self, messages: DataFrame) -> None:
        """Persist a message stream (column `value`) as JSON lines."""
        self._invalidate("landing")
        write_messages(messages.select(F.col("value").cast("string")), self.path("landing"))

    def ensure_landing(self, messages: Callable[[], DataFrame]) -> None:
        """Write the landing folder from `messages()` unless it is complete."""
        if "landing" not in self._ensured and not is_complete(self.spark, self.path("landing")):
            self.write_landing(messages())
        self._ensured.add("landing")

    def landing(self) -> DataFrame:
        return self._read("text", "landing")

    # -------------------------------------------------------------- ingest
    def parsed(self, keep_value: bool = False) -> DataFrame:
        return parse_messages(self.landing(), keep_value=keep_value)

    def valid(self) -> DataFrame:
        return valid_events(self.parsed(), self.tz)

    def deduplicated(self) -> DataFrame:
        return dedup_earliest(self.valid())

    def rejected(self) -> DataFrame:
        return rejected_events(self.parsed(keep_value=True))

    def build_bronze(self) -> None:
        """Batch ingest of the landing folder with one JSON parse pass.

        The parsed, judged messages are written once, partitioned by outcome
        (`_stage/status=valid|rejected`; valid rows without their raw text). The
        rejects come straight from their partition; bronze is typed and
        de-duplicated from the valid partition (a columnar read instead of a
        second parse of the text). The stage is a written table in the shared
        folder, so it also cuts the lineage and survives executor loss.
        """
        self._invalidate("bronze", "rejects")
        rules = validation_rules(check_json=True)
        parsed = parse_messages(self.landing(), keep_value=True)
        ok = is_valid(rules)
        stage = self.path("_stage")
        (
            parsed.select(
                F.when(ok, F.lit(None).cast("string")).otherwise(F.col("value")).alias("value"),
                *PARSED_COLUMNS,
                failed_rules(rules).alias("failed_rules"),
                F.when(ok, F.lit("valid")).otherwise(F.lit("rejected")).alias("status"),
            )
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("status")
            .parquet(stage, compression="zstd")
        )
        staged = self.spark.read.schema(STAGE_SCHEMA).parquet(stage)
        valid_text = staged.where(F.col("status") == "valid").select(*PARSED_COLUMNS)
        bronze = dedup_earliest(typed_events(valid_text, self.tz))
        bronze.withColumn("ingested_at", F.current_timestamp()).select(*BRONZE_COLUMNS).write.mode(
            "overwrite"
        ).parquet(self.path("bronze"), compression="zstd")
        staged.where(F.col("status") == "rejected").select("value", *PARSED_COLUMNS, "failed_rules").write.mode(
            "overwrite"
        ).parquet(self.path("rejects"), compression="zstd")

    def bronze(self) -> DataFrame:
        # Streaming ingest writes query_id=/batch_id= sub-folders; only the
        # declared columns are exposed either way.
        return self._read("batches", "bronze").select(*BRONZE_COLUMNS)

    def rejects(self) -> DataFrame:
        return self._read("batches", "rejects").drop("query_id", "batch_id")

    # -------------------------------------------------------------- silver
    def build_silver(self) -> None:
        """Full build of the dimensions and curated from all of bronze.

        Without its progress manifest a build that failed half-way is repeated in
        full by the next update, and gold owes everything until it is rebuilt.
        """
        self._invalidate("silver", "bronze")
        self._delete(self.path("silver", "_bronze_progress"))
        self._delete(self.path("silver", "_staging"))
        everything = self.spark.createDataFrame([(None,)], f"{EVENT_DATE} date")
        everything.coalesce(1).write.parquet(self.path("gold", "_pending", uuid.uuid4().hex))
        # Progress is taken before bronze is read: a batch committed in between
        # is then read again by the next update (harmless), never skipped.
        progress = self._batch_ids()
        bronze = self.bronze()
        S.user_first_seen(bronze).write.mode("overwrite").parquet(self.path("silver", "user_dim"))
        S.post_first_seen(bronze).write.mode("overwrite").parquet(self.path("silver", "post_dim"))
        curated = S.curated_events(self.bronze(), self.users(), self.posts())
        bounds = Observation("curated_bounds")
        self._write_curated(curated.observe(bounds, *_bounds_exprs()), dynamic=False)
        b = bounds.get
        self._write_bounds(b.get("max_event_timestamp"), b.get("min_event_timestamp"), int(b.get("row_count") or 0))
        self._write_progress(progress)

    def _write_curated(self, curated: DataFrame, dynamic: bool) -> None:
        # REBALANCE by the partition column: AQE splits a hot date into
        # advisory-size tasks and merges small ones, so the partitioned write gets
        # balanced tasks and few files per date folder, with no sampling pass
        # (a range repartition would run the joins twice).
        (
            curated.withColumn(EVENT_DATE, F.to_date("event_timestamp"))
            .hint("rebalance", EVENT_DATE)
            .write.mode("overwrite")
            # static: a full rebuild replaces the whole table (no stale date
            # folder survives); dynamic: an update replaces only the dates it writes.
            .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
            .partitionBy(EVENT_DATE)
            .parquet(self.path("silver", "curated"))
        )

    def _write_bounds(self, max_ts, min_ts, rows: int, root: str | None = None) -> None:
        # One-row manifest next to the table (metadata, not data).
        self.spark.createDataFrame(
            [(max_ts, min_ts, rows)],
            "max_event_timestamp timestamp_ntz, min_event_timestamp timestamp_ntz, row_count bigint",
        ).coalesce(1).write.mode("overwrite").parquet((root or self.path("silver")) + "/curated_bounds")

    # ------------------------------------------------------ incremental silver
    def _batch_ids(self) -> dict[str, int]:
        """Highest committed micro-batch id per stream query in bronze (empty
        for a batch-written bronze). Paths only, listed on the driver."""
        from ripplecast.streaming.ingest import committed_batches

        out: dict[str, int] = {}
        for path in committed_batches(self.spark, self.path("bronze")):
            qid, bid = _batch_of(path)
            out[qid] = max(out.get(qid, -1), bid)
        return out

    def _write_progress(self, progress: dict[str, int], root: str | None = None) -> None:
        self.spark.createDataFrame(
            sorted(progress.items()) or [("", -1)], "query_id string, max_batch_id bigint"
        ).coalesce(1).write.mode("overwrite").parquet((root or self.path("silver")) + "/_bronze_progress")

    def _read_progress(self) -> dict[str, int] | None:
        path = self.path("silver", "_bronze_progress")
        if not is_complete(self.spark, path):
            return None
        rows = self.spark.read.parquet(path).collect()  # one row per stream query
        return {r.query_id: int(r.max_batch_id) for r in rows if r.query_id}

    def update_silver(self) -> bool:
        """Fold the bronze micro-batches committed since the last silver build
        into silver: the same tables a full rebuild gives, but it reads only the
        new batches, the dimensions and the curated dates that change.

        * dimensions: first-seen rows of (old ∪ new) from the stored first rows
          and the new batches' first rows (dimensions are small next to events);
        * curated: dates that receive new events, and dates holding events whose
          actor / target / post dimension row changed (new, or seen earlier by a
          late event), are recomputed from their own base columns plus the new
          events and replaced by a dynamic partition overwrite; other dates stay.

        Everything new is first written to a staging folder of its own, the progress
        last; only then are the tables replaced from there (`_apply_silver`). A run that
        fails before the staged progress is committed has changed nothing and its
        staging folder is discarded; one that fails later is finished from the staging
        folder by the next update. So no batch is folded in twice, and events that
        repeat an id stay, as in a full build. Returns False when there is nothing
        new; without a progress manifest it does a full build.
        """
        from ripplecast.plans.lineage import cut_lineage
        from ripplecast.streaming.ingest import committed_batches

        recovered = self._recover_silver()
        progress = self._read_progress()
        if progress is None or not is_complete(self.spark, self.path("silver", "curated")):
            self.build_silver()
            return True
        new_paths, seen = [], dict(progress)
        for path in committed_batches(self.spark, self.path("bronze")):
            qid, bid = _batch_of(path)
            if bid > progress.get(qid, -1):
                new_paths.append(path)
                seen[qid] = max(seen.get(qid, -1), bid)
        if not new_paths:
            return recovered
        new = self.spark.read.option("basePath", self.path("bronze")).parquet(*new_paths).select(*BRONZE_COLUMNS)

        old_users = self._read("parquet", "silver", "user_dim")
        old_posts = self._read("parquet", "silver", "post_dim")
        new_users, new_posts = S.user_first_seen(new), S.post_first_seen(new)
        users = cut_lineage(S.merge_first_seen(old_users, new_users, "user_id"))
        posts = cut_lineage(S.merge_first_seen(old_posts, new_posts, "post_id"))

        def changed(merged: DataFrame, old: DataFrame, firsts: DataFrame, key: str) -> DataFrame:
            # Only keys seen in the new batches can change: compare just those
            # rows (set difference, so NULLs compare equal).
            keys = firsts.select(key)
            return merged.join(keys, key, "left_semi").exceptAll(old.join(keys, key, "left_semi")).select(key)

        changed_users = changed(users, old_users, new_users, "user_id")
        changed_posts = changed(posts, old_posts, new_posts, "post_id")

        cur = self.curated_partitioned()
        base = ("event_id", "event_type", "user_id", "target_user_id", "post_id", "comment_text", "event_timestamp")
        as_target = changed_users.withColumnRenamed("user_id", "target_user_id")

        def dates_of(key: str, keys: DataFrame) -> DataFrame:
            # Distinct (key, date) pairs first: partial aggregation collapses a
            # hot key (a user with a third of all events) to one row per date
            # before any join sees it.
            pairs = cur.where(F.col(key).isNotNull()).select(key, EVENT_DATE).distinct()
            return pairs.join(keys, key, "left_semi").select(EVENT_DATE)

        touched = (
            dates_of("user_id", changed_users)
            .unionByName(dates_of("target_user_id", as_target))
            .unionByName(dates_of("post_id", changed_posts))
            .unionByName(new.select(F.to_date("event_timestamp").alias(EVENT_DATE)))
            .distinct()
        )
        stage = self.path("silver", "_staging", uuid.uuid4().hex)
        touched.coalesce(1).write.parquet(stage + "/dates")
        touched = self.spark.read.schema(f"{EVENT_DATE} date").parquet(stage + "/dates")
        replaced = Observation("replaced_rows")
        # `touched` holds at most one row per date folder of curated (a proven
        # bound), so it is broadcast: no shuffle of curated by date, where a hot
        # day would land in one task.
        old_rows = cur.join(F.broadcast(touched), EVENT_DATE, "left_semi").select(*base).observe(
            replaced, F.count(F.lit(1)).alias("n")
        )
        events = old_rows.unionByName(new.select(*base))
        recomputed = S.curated_events(
            events, users.select(*S.USER_DIM_COLUMNS), posts.select(*S.POST_DIM_COLUMNS)
        )
        written = Observation("recomputed_bounds")
        recomputed.observe(written, *_bounds_exprs()).write.parquet(stage + "/curated")
        users.write.parquet(stage + "/user_dim")
        posts.write.parquet(stage + "/post_dim")
        prev = self._read("parquet", "silver", "curated_bounds").collect()[0]  # the one-row manifest
        b = written.get
        self._write_bounds(
            _extreme(max, prev.max_event_timestamp, b.get("max_event_timestamp")),
            _extreme(min, prev.min_event_timestamp, b.get("min_event_timestamp")),
            int(prev.row_count) - int(replaced.get.get("n") or 0) + int(b.get("row_count") or 0),
            stage,
        )
        self._write_progress(seen, stage)  # commits the staged update
        self._apply_silver(stage)
        return True

    def _apply_silver(self, stage: str) -> None:
        """Replace the silver tables from a committed staging folder; safe to repeat."""
        # Before any table changes: gold owes these dates until it has folded them in.
        owed = self.path("gold", "_pending", stage.rsplit("/", 1)[-1])
        self.spark.read.parquet(stage + "/dates").write.mode("overwrite").parquet(owed)
        self._write_curated(self.spark.read.parquet(stage + "/curated").drop(EVENT_DATE), dynamic=True)
        for name in ("user_dim", "post_dim", "curated_bounds", "_bronze_progress"):
            table = self.spark.read.parquet(f"{stage}/{name}")
            table.write.mode("overwrite").parquet(self.path("silver", name))
        self._invalidate("silver", "bronze")  # bronze has new batches too
        self._delete(stage)

    def _recover_silver(self) -> bool:
        """Finish an update that failed after its staging folder was committed; drop others."""
        found = self._children(self.path("silver", "_staging"))
        committed = [p for p in found if is_complete(self.spark, p + "/_bronze_progress")]
        for stage in committed:
            self._apply_silver(stage)
        for stage in set(found) - set(committed):
            self._delete(stage)
        return bool(committed)

    def _children(self, folder: str) -> list[str]:
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(str(s.getPath().toString()) for s in fs.listStatus(root)) if fs.exists(root) else []

    def _delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def users(self) -> DataFrame:
        return self._read("parquet", "silver", "user_dim").select(*S.USER_DIM_COLUMNS)

    def posts(self) -> DataFrame:
        return self._read("parquet", "silver", "post_dim").select(*S.POST_DIM_COLUMNS)

    def curated_partitioned(self) -> DataFrame:
        """Curated with its `event_date` partition column (enables pruning)."""
        return self._read("parquet", "silver", "curated")

    def latest_event_time(self) -> Column:
        """MAX(event_timestamp) of curated as a scalar subquery over the one-row
        bounds manifest written with the table; falls back to scanning curated."""
        if is_complete(self.spark, self.path("silver", "curated_bounds")):
            return self._read("parquet", "silver", "curated_bounds").select("max_event_timestamp").scalar()
        return G.latest_event_time(self.curated_partitioned())

    def curated(self) -> DataFrame:
        from ripplecast.schema import CURATED_COLUMNS

        return self.curated_partitioned().select(*CURATED_COLUMNS)

    # ---------------------------------------------------------------- gold
    def gold_frame(self, name: str) -> DataFrame:
        p = self.gold_params
        cur = self.curated_partitioned()
        if name == "trending_hashtags":
            return G.trending_hashtags(cur, p.trending_windows_minutes, p.trending_top_n, latest=self.latest_event_time())
        if name == "viral_posts":
            return G.viral_posts(
                cur, p.viral_window_minutes, p.viral_threshold, p.run_ts, self.tz, latest=self.latest_event_time()
            )
        if name == "influencer_ranking":
            return G.influencer_ranking(cur, self.users(), run_ts=p.run_ts, session_tz=self.tz)
        if name == "comment_sentiment":
            return G.comment_sentiment(cur, p.run_ts, self.tz)
        raise KeyError(name)

    def gold_frames(self) -> dict[str, DataFrame]:
        return {n: self.gold_frame(n) for n in GOLD_TABLES}

    def build_gold(self) -> None:
        """All gold tables from curated. Sentiment and the daily creator
        rollup behind the influencer ranking are partitioned by date, so an
        update can replace just the dates it touched (`update_gold`)."""
        self._invalidate("gold")
        pending = self.gold_pending()
        p = self.gold_params
        cur = self.curated_partitioned()
        for name in ("trending_hashtags", "viral_posts"):
            self.gold_frame(name).write.mode("overwrite").parquet(self.path("gold", name))
        self._write_dated(G.comment_sentiment(cur, p.run_ts, self.tz), "comment_sentiment", dynamic=False)
        self._write_dated(G.engagement_counts(cur, by=(EVENT_DATE,)), "_creator_daily", dynamic=False)
        self._write_ranking()
        self._settle(pending)

    def _write_dated(self, df: DataFrame, name: str, dynamic: bool) -> None:
        if EVENT_DATE not in df.columns:
            df = df.withColumn(EVENT_DATE, F.to_date("event_timestamp"))
        # As for curated: few files per date folder whatever the partitions before.
        (
            df.hint("rebalance", EVENT_DATE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
            .partitionBy(EVENT_DATE)
            .parquet(self.path("gold", name))
        )

    def _write_ranking(self) -> None:
        p = self.gold_params
        daily = self.spark.read.schema(DATED_SCHEMAS[("gold", "_creator_daily")]).parquet(
            self.path("gold", "_creator_daily")
        )
        ranking = G.influencer_ranking_from_daily(daily, self.users(), run_ts=p.run_ts, session_tz=self.tz)
        ranking.write.mode("overwrite").parquet(self.path("gold", "influencer_ranking"))

    def gold_pending(self) -> list[str]:
        """Folders of touched dates that gold has not folded in yet (one per silver update)."""
        return [p for p in self._children(self.path("gold", "_pending")) if is_complete(self.spark, p)]

    def _settle(self, pending: list[str]) -> None:
        for p in pending:
            self._delete(p)

    def update_gold(self) -> None:
        """Gold after `update_silver`: sentiment and the daily rollup are recomputed
        from curated for every date that a silver update touched and gold has not
        folded in yet, and replaced by dynamic partition overwrite; the ranking is
        re-ranked from the rollup (creators × days rows); the latest-window tables
        read only the last date folders anyway.

        The list of owed dates shrinks only after all tables are written, so a run
        that fails at any write is repeated by the next one, whatever silver did since.
        """
        pending = self.gold_pending()
        if not pending or not is_complete(self.spark, self.path("gold", "_creator_daily")):
            self.build_gold()
            return
        dates = self.spark.read.schema(f"{EVENT_DATE} date").parquet(*pending).distinct()
        if not dates.where(F.col(EVENT_DATE).isNull()).isEmpty():  # silver was rebuilt
            self.build_gold()
            return
        self._invalidate("gold")
        p = self.gold_params
        # One row per date folder of curated at most: broadcast.
        redo = self.curated_partitioned().join(F.broadcast(dates), EVENT_DATE, "left_semi")
        for name in ("trending_hashtags", "viral_posts"):
            self.gold_frame(name).write.mode("overwrite").parquet(self.path("gold", name))
        self._write_dated(G.comment_sentiment(redo, p.run_ts, self.tz), "comment_sentiment", dynamic=True)
        self._write_dated(G.engagement_counts(redo, by=(EVENT_DATE,)), "_creator_daily", dynamic=True)
        self._write_ranking()
        self._settle(pending)

    def gold(self, name: str) -> DataFrame:
        df = self._read("parquet", "gold", name)
        return df.drop(EVENT_DATE) if name == "comment_sentiment" else df

    # ---------------------------------------------------------- everything
    def ensure(self, upto: str = "gold") -> "Lakehouse":
        """Build missing layers up to `upto` (bronze | silver | gold)."""
        if upto in self._ensured:
            return self
        order = ["bronze", "silver", "gold"]
        marks = {
            "bronze": self.path("bronze"),
            "silver": self.path("silver", "curated"),
            "gold": self.path("gold", "comment_sentiment"),
        }
        builders = {"bronze": self.build_bronze, "silver": self.build_silver, "gold": self.build_gold}
        rebuilt = False
        for layer in order[: order.index(upto) + 1]:
            done = is_complete(self.spark, marks[layer])
            if layer == "bronze" and not done:
                # bronze written by the streaming sink: committed batch folders
                from ripplecast.streaming.ingest import committed_batches

                done = bool(committed_batches(self.spark, marks[layer]))
            # A rebuilt layer invalidates everything derived from it.
            if rebuilt or not done:
                builders[layer]()
                rebuilt = True
        self._ensured.update(order[: order.index(upto) + 1])
        return self


def _batch_of(path: str) -> tuple[str, int]:
    """(query id, batch id) of a `…/query_id=<q>/batch_id=<n>` folder."""
    parts = path.rstrip("/").split("/")
    return parts[-2].split("=", 1)[1], int(parts[-1].split("=", 1)[1])


def _extreme(pick, a, b):
    vals = [x for x in (a, b) if x is not None]
    return pick(vals) if vals else None


def _bounds_exprs() -> list[Column]:
    return [
        F.max("event_timestamp").alias("max_event_timestamp"),
        F.min("event_timestamp").alias("min_event_timestamp"),
        F.count(F.lit(1)).alias("row_count"),
    ]


# Catalog names of the layers (database, table) → folder parts.
CATALOG_TABLES: dict[tuple[str, str], tuple[str, ...]] = {
    ("bronze", "raw_events"): ("bronze",),
    ("bronze", "rejected_events"): ("rejects",),
    ("silver", "user_dim"): ("silver", "user_dim"),
    ("silver", "post_dim"): ("silver", "post_dim"),
    ("silver", "curated_events"): ("silver", "curated"),
    ("gold", "trending_hashtags"): ("gold", "trending_hashtags"),
    ("gold", "viral_posts"): ("gold", "viral_posts"),
    ("gold", "influencer_ranking"): ("gold", "influencer_ranking"),
    ("gold", "comment_sentiment"): ("gold", "comment_sentiment"),
    ("gold", "quality_report"): ("gold", "quality_report"),
}


# Declared schemas where the folder holds more (the dimensions keep the
# ordering key of their first-seen row for incremental updates).
CATALOG_SCHEMAS: dict[tuple[str, str], str] = {
    ("silver", "user_dim"): "user_id STRING, username STRING, country STRING, created_at TIMESTAMP_NTZ",
    ("silver", "post_dim"): "post_id STRING, user_id STRING, hashtag STRING, created_at TIMESTAMP_NTZ",
}


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return row and row.data_type


def _same_folder(spark: SparkSession, a: str | None, b: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return a is not None and path(a).toUri().getPath() == path(b).toUri().getPath()


def _register_batches(spark: SparkSession, name: str, folder: str) -> None:
    """The table's partitions become the committed micro-batches: a folder still being written stays out of sight."""
    from ripplecast.streaming.ingest import committed_batches

    want = {f"query_id={q}/batch_id={b}" for q, b in map(_batch_of, committed_batches(spark, folder))}
    have = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}  # metadata: one row a micro-batch

    def specs(parts: list[str], sep: str) -> str:
        return sep.join("PARTITION (query_id='{}', batch_id={})".format(*_batch_of(p)) for p in parts)

    for verb, parts, sep in (("DROP IF EXISTS", sorted(have - want), ", "), ("ADD IF NOT EXISTS", sorted(want - have), " ")):
        for at in range(0, len(parts), 1000):
            spark.sql(f"ALTER TABLE {name} {verb} {specs(parts[at : at + 1000], sep)}")


def register_catalog(lake: Lakehouse, prefix: str = "") -> list[str]:
    """Expose the written layers as catalog tables `<prefix>bronze.raw_events`,
    `<prefix>silver.curated_events`, `<prefix>gold.viral_posts`, … (external
    Parquet tables over the layer folders), so SQL users can query them with
    `spark.sql`. Idempotent; only metadata is touched (the tables are
    external). Call again after new micro-batches land to register their folders."""
    spark = lake.spark
    made = []
    for (db, table), parts in CATALOG_TABLES.items():
        if not is_complete(spark, lake.path(*parts)) and not _hadoop_exists(spark, lake.path(*parts)):
            continue
        database = f"{prefix}{db}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        location = lake.path(*parts).replace("'", "\\'")
        ddl = CATALOG_SCHEMAS.get((db, table))
        columns = f"({ddl}) " if ddl else ""
        name = f"{database}.{table}"
        if not _same_folder(spark, _location(spark, name), lake.path(*parts)):
            # External tables: dropping one removes only catalog metadata, so the
            # catalog is re-pointed at this lake even if another lake was registered.
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            try:
                spark.sql(f"CREATE TABLE {name} {columns}USING parquet LOCATION '{location}'")
            except Exception as e:  # noqa: BLE001
                if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                    raise
                continue  # folder holds no data file yet: nothing to expose
        keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        if keys == ["query_id", "batch_id"]:
            _register_batches(spark, name, lake.path(*parts))
        elif keys:
            # Date folders: register new ones and drop vanished ones.
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.sql(f"REFRESH TABLE {name}")
        made.append(f"{database}.{table}")
    return made

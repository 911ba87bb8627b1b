"""Problem 1: train, validation and test splits that keep related records together.

A persisted table holds, for each key value (sitting, minute taker, recording), the
component it belongs to, and for each record its component. A batch of records adds keys, records and links between
keys; components are merged by hooking every root to its smallest neighbour and jumping
pointers until all point at roots. A component that exists keeps its split; new
components fill the splits that lack most; components whose parts had different splits
are quarantined. A batch writes only what it adds or changes: new keys and records, changed
components, and the table of merged components, to which older rows are resolved when they are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ._common import cut, plain_key, read, scratch, stem_key

QUARANTINE = "quarantine"
KEY_TABLE = "key string, comp bigint"
RECORD_TABLE = "rec_id bigint, comp bigint"
COMP_TABLE = "comp bigint, split string, held int, n bigint"
MERGE_TABLE = "old bigint, root bigint"
#: A key or component with more than this share of the rows is met by broadcast, so that no task gets all its rows. There are at most 1 / HOT of them.
HOT, LEAST_HOT = 0.001, 100_000


def record_keys(records: DataFrame) -> DataFrame:
    """(rec_id, key): one row for each known key value of a record.

    A record without any gets the key of itself; rows of the same record count once;
    rows without rec_id are left out.
    """
    kinds = F.array_compact(
        F.array(
            F.concat(F.lit("sitting:"), stem_key(F.col("meta.stem"))),
            F.concat(F.lit("taker:"), plain_key(F.col("author"))),
            F.concat(F.lit("recording:"), plain_key(F.col("source"))),
        )
    )
    own = F.array(F.concat(F.lit("record:"), F.col("rec_id")))
    keys = records.where("rec_id is not null").select("rec_id", kinds.alias("keys"))
    return keys.select("rec_id", F.explode(F.when(F.size("keys") > 0, F.col("keys")).otherwise(own)).alias("key")).distinct()


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows that the optimizer knows to be empty."""
    return spark.sql("select " + ", ".join(f"cast(null as {t}) as {c}" for c, t in (x.split() for x in schema.split(", "))) + " where false")


def spread_join(rows: DataFrame, small: DataFrame, on: str, most: int) -> DataFrame:
    """``rows`` with the columns of ``small``, which has one row for each value of ``on``, where there is one (left join).

    most: at least the number of rows. Values with more than HOT of these (and LEAST_HOT rows, which one task can take) are joined by
    broadcast, the others by their hash; with fewer rows in all there are no such values.
    """
    least = max(LEAST_HOT, HOT * most)
    hot = [r[0] for r in rows.groupBy(on).agg(F.count("*").alias("_n")).where(F.col("_n") > least).select(on).collect()] if most > least else []
    if not hot:
        return rows.join(small, on, "left")
    is_hot = F.coalesce(F.col(on).isin(hot), F.lit(False))
    return rows.where(is_hot).join(F.broadcast(small.where(is_hot)), on, "left").unionByName(rows.where(~is_hot).join(small, on, "left"))


def roots_of(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, root) of the nodes of ``edges`` (a, b bigint; at most ``most``): root is the component's smallest node.

    Each round hooks every node to its smallest neighbour, jumps pointers until they end at
    roots, and keeps the links between different roots. A hub costs no more than its rows:
    minima are combined before the shuffle, and its pointers are met by broadcast.
    """
    spark = edges.sparkSession
    links = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    most = 2 * (links.count() if most is None else most)
    total: DataFrame | None = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        up = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
        while True:
            to = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            up = cut(spread_join(up.select("node", "root"), to, "root", most).select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
            if up.where("moved").isEmpty():
                up = up.drop("moved")
                break
        a, b = (up.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
        moved = spread_join(spread_join(links, a, "a", most), b, "b", most).where("ra <> rb")
        links = cut(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        if total is None:
            total = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            total = cut(spread_join(total, step, "root", most).select("node", F.coalesce("next", "root").alias("root")))
    return total if total is not None else empty(spark, "node bigint, root bigint")


@dataclass
class State:
    """keys: key, comp. records: rec_id, comp. comps: comp, split, held, n (records); a comp without split is gone. merges: old, root of the components that were merged."""

    keys: DataFrame
    records: DataFrame
    comps: DataFrame
    merges: DataFrame


class ComponentStore:
    """The table on disk: one folder a version with what it adds; a version counts once its marker is written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def version(self) -> int:
        fs, p = self._fs(self.path)
        names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        done = [int(x[5:]) for x in names if x.startswith("done-")]
        return max(done, default=0)

    def read(self) -> State:
        v = self.version()

        def table(name: str, schema: str, versions) -> DataFrame:
            paths = [f"{self.path}/v{i}/{name}" for i in versions]
            return self.spark.read.schema(schema).parquet(*paths) if paths else empty(self.spark, schema)

        every = range(1, v + 1)
        merges = table("merges", MERGE_TABLE, [v] if v else [])
        # rows of older versions may name components that were merged since
        to = lambda rows: rows.join(merges, rows["comp"] == merges["old"], "left").select(*[c for c in rows.columns if c != "comp"], F.coalesce("root", "comp").alias("comp"))
        comps = table("comps", f"{COMP_TABLE}, version int", every)
        last = comps.groupBy("comp").agg(F.max_by(F.struct("split", "held", "n"), "version").alias("x")).select("comp", "x.split", "x.held", "x.n").where("split is not null")
        return State(to(table("keys", KEY_TABLE, every)), to(table("records", RECORD_TABLE, every)), last, merges)

    def write(self, added: State) -> State:
        """Add new keys and records, changed components and all merges, as :func:`update` gives them."""
        v = self.version() + 1
        at = f"{self.path}/v{v}"
        added.keys.write.mode("overwrite").parquet(f"{at}/keys")
        added.records.write.mode("overwrite").parquet(f"{at}/records")
        added.comps.withColumn("version", F.lit(v)).write.mode("overwrite").parquet(f"{at}/comps")
        added.merges.write.mode("overwrite").parquet(f"{at}/merges")
        fs, p = self._fs(f"{self.path}/done-{v}")
        fs.create(p).close()
        return self.read()


def _filled(new: DataFrame, had: dict[str, int], shares: dict[str, float]) -> DataFrame:
    """Give each row of ``new`` (comp, held, n) a split so that the shares are reached.

    The components stand in a line, largest first, and the splits' deficits are laid along
    it: free components first to train, then validation, test; held ones only to the two
    latter. The line is a prefix sum over range partitions; only the sums of the partitions
    pass through the driver.
    """
    spark = new.sparkSession
    sums = {bool(r["held"]): r["n"] for r in new.groupBy("held").agg(F.sum("n").alias("n")).collect()}
    total = sum(had.values()) + sum(sums.values())
    lack = {s: max(0.0, shares[s] * total - had.get(s, 0)) for s in shares}
    out = None
    for held in (True, False):
        if not sums.get(held):
            continue
        names = [s for s in shares if not (held and s == "train")]
        room = [lack[s] for s in names]
        scale = sums[held] / sum(room) if sum(room) else 0
        if scale == 0:
            room, scale = [shares[s] for s in names], sums[held] / sum(shares[s] for s in names)
        own = new.where(F.col("held") == int(held))
        line = cut(own.repartitionByRange(F.col("n").desc(), F.col("comp")).sortWithinPartitions(F.col("n").desc(), "comp").withColumn("part", F.spark_partition_id()))
        before, at = {}, 0
        for r in line.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
            before[r["part"]], at = at, at + r["n"]
        starts = spark.createDataFrame(list(before.items()), "part int, before bigint")
        upto = F.sum("n").over(W.partitionBy("part").orderBy(F.col("n").desc(), "comp").rowsBetween(W.unboundedPreceding, W.currentRow))
        placed = line.join(F.broadcast(starts), "part").withColumn("mid", F.col("before") + upto - F.col("n") / 2)
        split, bound = F.lit(names[-1]), sum(room) * scale
        for s, x in reversed(list(zip(names[1:], room[1:]))):
            bound -= x * scale
            split = F.when(F.col("mid") < bound, names[names.index(s) - 1]).otherwise(split)
        part = cut(placed.select("comp", split.alias("split"), "held", "n"))
        for r in part.groupBy("split").agg(F.sum("n").alias("n")).collect():
            lack[r["split"]] = max(0.0, lack[r["split"]] - r["n"])
        out = part if out is None else out.unionByName(part)
    return out if out is not None else empty(spark, COMP_TABLE)


def update(prior: State, records: DataFrame, manifest: DataFrame, shares: dict[str, float] | None = None) -> tuple[State, DataFrame]:
    """Add a batch to the table. Gives what it adds or changes (for :meth:`ComponentStore.write`) and (rec_id, comp) of the batch.

    shares: wanted proportion of each split, train first. held is 1 for components with a
    sitting named in ``manifest``; they never go to train (one that already is there is
    quarantined). Nulls and stand-ins tie nothing; an empty batch changes nothing. A record delivered again counts
    once and ties its old component to its new keys.
    """
    shares = shares or {"train": 0.8, "validation": 0.1, "test": 0.1}
    rk = cut(record_keys(records))
    most = 2 * rk.count()
    ids = rk.select("rec_id").distinct()
    seen = cut(prior.records.join(ids, "rec_id", "left_semi"))
    label = rk.groupBy("key").agg(F.min("rec_id").alias("first")).join(prior.keys.select("key", F.col("comp").alias("old")), "key", "left")
    # a new key's label is a record of the batch, or the component of this record if it is an old one
    label = label.join(seen.select(F.col("rec_id").alias("first"), F.col("comp").alias("was")), "first", "left")
    label = cut(label.select("key", F.coalesce("old", "was", "first").alias("label"), F.col("old").isNull().alias("new")))
    labels = spread_join(rk, label.select("key", "label"), "key", most).select("rec_id", "label").unionByName(seen.select("rec_id", F.col("comp").alias("label")))
    labels = labels.distinct()
    low = cut(labels.groupBy("rec_id").agg(F.min("label").alias("low")))
    edges = labels.join(low, "rec_id").select(F.col("low").alias("a"), F.col("label").alias("b")).distinct()
    root = cut(roots_of(edges, most))
    to = root.select(F.col("node").alias("low"), "root")
    comp_of = cut(spread_join(low, to, "low", most).select("rec_id", F.coalesce("root", "low").alias("comp")))
    new_keys = cut(label.where("new").join(root, F.col("label") == F.col("node"), "left").select("key", F.coalesce("root", "label").alias("comp")))
    new_records = comp_of.join(seen.select("rec_id"), "rec_id", "left_anti")
    # components of the table that take part, and what becomes of them
    was = cut(prior.comps.join(root, F.col("comp") == F.col("node"), "left").select("comp", F.coalesce("root", "comp").alias("into"), "split", "n", "held"))
    named = manifest.select(F.concat(F.lit("sitting:"), stem_key(F.col("stem"))).alias("key")).where("key is not null").distinct()
    held = prior.keys.join(named, "key", "left_semi").select("comp").join(root, F.col("comp") == F.col("node"), "left").select(F.coalesce("root", "comp").alias("comp"))
    held = held.unionByName(new_keys.join(named, "key", "left_semi").select("comp")).distinct().withColumn("is_held", F.lit(1))
    now = new_records.groupBy("comp").agg(F.count("*").alias("n_new"))
    old = was.groupBy(F.col("into").alias("comp")).agg(F.min("split").alias("split"), F.count_distinct("split").alias("splits"), F.sum("n").alias("n_old"), F.max("held").alias("held_old"), F.count("*").alias("parts"))
    comps = old.join(now, "comp", "full").join(held, "comp", "left")
    is_held = F.greatest(F.coalesce("is_held", F.lit(0)), F.coalesce("held_old", F.lit(0)))
    clash = (F.col("splits") > 1) | ((F.col("split") == "train") & (is_held == 1))
    comps = cut(comps.select("comp", "splits", "parts", "n_new", "held_old", "split", F.when(clash, QUARANTINE).otherwise(F.col("split")).alias("now"), is_held.alias("held"), (F.coalesce("n_old", F.lit(0)) + F.coalesce("n_new", F.lit(0))).alias("n")))
    stay = comps.where("splits is not null")
    had = {r["now"]: r["n"] for r in stay.groupBy("now").agg(F.sum("n").alias("n")).collect() if r["now"] in shares}
    fresh = _filled(comps.where("splits is null").select("comp", "held", "n"), had, shares).select("comp", "split", "held", "n")
    changed = stay.where("parts > 1 or n_new is not null or now <> split or held <> held_old").select("comp", F.col("now").alias("split"), "held", "n")
    gone = was.where("comp <> into").select("comp", F.lit(None).cast("string").alias("split"), F.lit(0).alias("held"), F.lit(0).cast("bigint").alias("n"))
    # every label that is no root, and the earlier merges into such
    merges = prior.merges.join(root, prior.merges["root"] == root["node"], "left").select("old", F.coalesce(root["root"], prior.merges["root"]).alias("root"))
    merges = merges.unionByName(gone.select(F.col("comp").alias("old")).join(root, F.col("old") == F.col("node")).select("old", "root"))
    return State(new_keys, cut(new_records), changed.unionByName(gone).unionByName(fresh), cut(merges)), comp_of


def found(records: DataFrame, manifest: DataFrame, store: ComponentStore) -> DataFrame:
    """Records in groups of at least two: rec_id, group_id (smallest rec_id), held."""
    added, comp_of = update(store.read(), records, manifest)
    comps = store.write(added).comps.where("n > 1").select("comp", "held")
    j = spread_join(comp_of, comps, "comp", comp_of.count()).where("held is not null")
    return j.select("rec_id", F.col("comp").alias("group_id"), F.col("held").cast(T.IntegerType()).alias("held"))


def p1_found(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """path: folder of the component table to which the records are added; a new one in the shared folder if not given."""
    store = ComponentStore(spark, path or scratch(spark, "components"))
    return found(read(spark, sf_dir, "records"), read(spark, sf_dir, "manifest"), store)


def p1_splits(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """(rec_id, group_id, split, held) after two batches: the builds up to the median time, then the later ones."""
    records, manifest = read(spark, sf_dir, "records"), read(spark, sf_dir, "manifest")
    mid = records.select(F.percentile_approx("built_at", 0.5)).first()[0]
    store = ComponentStore(spark, path or scratch(spark, "components"))
    early = F.coalesce(F.col("built_at") <= F.lit(mid), F.lit(True))
    store.write(update(store.read(), records.where(early), manifest)[0])
    state = store.write(update(store.read(), records.where(~early), manifest)[0])
    return spread_join(state.records, state.comps, "comp", state.records.count()).select("rec_id", F.col("comp").alias("group_id"), "split", F.col("held").cast("int").alias("held"))


def queries() -> dict:
    return {"p1_found": p1_found, "p1_splits": p1_splits}


def oracle_sql() -> dict[str, str]:
    return {}

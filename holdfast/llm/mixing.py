"""Mixing documents to target weights with a min-cost flow between overlapping sources.

Documents are summed by membership pattern (the set of sources they belong to). The flow routes tokens of
the patterns to the quotas of the sources; each repetition of a pattern costs more than the one before,
so repetition starts where nothing else can fill a quota. Only the pattern sums reach the driver. The
flow's result says how many words of each pattern are taken; whole documents are then picked in a seeded
order by running sums over hash buckets, so that no task ever holds a pattern.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import SPACED_WORD
from holdfast.session import staged

REPEATS = 3  # times a document may be taken
SEED = 41
BUCKETS = 1 << 12  # of a pattern's seeded order
MOST_PATTERNS = 200_000  # membership patterns whose sums the driver takes


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], total: int, cap: int = REPEATS) -> dict[str | None, float]:
    """Target words of each source: weights 1, 2, 3 in turn by code point (null last) share the total; what a target exceeds `cap` times its source's size by is shared anew among the others."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: i % 3 + 1 for i, (s, _) in enumerate(ordered)}
    size = dict(ordered)
    left, open_ = float(total), dict(weight)
    out: dict[str | None, float] = {}
    while open_:
        share = left / sum(open_.values())
        over = [s for s, w in open_.items() if share * w > cap * size[s]]
        if not over:
            return out | {s: share * w for s, w in open_.items()}
        for s in over:
            out[s] = float(cap * size[s])
            left -= out[s]
            del open_[s]
    return out


def min_cost_flow(capacity: dict[tuple, int], quota: dict[str | None, int], repeats: int = REPEATS) -> dict[tuple[tuple, str | None], int]:
    """Words to take of each pattern for each of its sources.

    A pattern gives its size once for nothing, a second time at cost 1, a third at cost 2 and so on.
    Successive cheapest augmenting paths with potentials fill every quota as far as capacity allows.
    """
    graph: dict = defaultdict(list)  # node -> edges [to, room, cost, index of the reverse]

    def edge(a, b, room: int, cost: int) -> None:
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p in sorted(capacity, key=repr):
        for level in range(repeats):
            edge("in", ("p", p), capacity[p], level)
        for s in p:
            edge(("p", p), ("s", s), repeats * capacity[p], 0)
    for s in sorted(quota, key=repr):
        edge(("s", s), "out", quota[s], 0)
    potential: dict = defaultdict(int)
    while True:
        far, back, queue = {"in": 0}, {}, [(0, 0, "in")]
        n = 0
        while queue:
            d, _, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for i, (b, room, cost, _) in enumerate(graph[a]):
                if room > 0 and (near := d + cost + potential[a] - potential[b]) < far.get(b, 1 << 60):
                    n += 1
                    far[b], back[b] = near, (a, i)
                    heapq.heappush(queue, (near, n, b))
        if "out" not in far:
            break
        for a in graph:
            potential[a] += min(far.get(a, far["out"]), far["out"])
        path, a = [], "out"
        while a != "in":
            path.append(back[a])
            a = back[a][0]
        room = min(graph[a][i][1] for a, i in path)
        for a, i in path:
            graph[a][i][1] -= room
            graph[graph[a][i][0]][graph[a][i][3]][1] += room
    return {(p, s): repeats * capacity[p] - e[1] for p in capacity for e in graph[("p", p)] if isinstance(e[0], tuple) and e[0][0] == "s" for s in [e[0][1]]}


def flows(capacity: dict[tuple, int], quota: dict[str | None, int], repeats: int = REPEATS) -> dict[tuple[tuple, str | None], int]:
    """`min_cost_flow` for each set of patterns that overlapping sources connect. A pattern of one source that stands in
    no other pattern needs no search: its words fill the quota, all of them once before any is taken again."""
    parent: dict = {}

    def root(s: str | None) -> str | None:
        while parent.setdefault(s, s) != s:
            parent[s] = s = parent[parent[s]]
        return s

    for p in capacity:
        for s in p[1:]:
            parent[root(s)] = root(p[0])
    connected: dict = defaultdict(dict)
    for p, n in capacity.items():
        connected[root(p[0])][p] = n
    out: dict[tuple[tuple, str | None], int] = {}
    for part in connected.values():
        first = next(iter(part))
        if len(part) == 1 and len(first) == 1:
            out[first, first[0]] = min(quota[first[0]], repeats * part[first])
        else:
            sources = {s for p in part for s in p}
            out |= min_cost_flow(part, {s: quota[s] for s in sources}, repeats)
    return out


NULL_SOURCE = "0"  # name of the missing source inside patterns; others get the prefix "1"


def _pattern(sources: Column) -> Column:
    """Sorted distinct sources of a document; none at all counts as the missing source."""
    named = F.transform(F.coalesce(sources, F.array()), lambda s: F.coalesce(F.concat(F.lit("1"), s), F.lit(NULL_SOURCE)))
    return F.array_sort(F.array_distinct(F.when(F.size(named) > 0, named).otherwise(F.array(F.lit(NULL_SOURCE)))))


def _source(name: str) -> str | None:
    return None if name == NULL_SOURCE else name[1:]


def _pick(members: DataFrame, taken: dict[tuple, int], sizes: dict[tuple, int], key: str) -> DataFrame:
    """`members` (pattern, size, key) with `taken`: whole repetitions for all documents of a pattern, and one
    more for the first of them in seeded order.

    The rest that the next document would overshoot is filled up with one later document of each falling
    power of two, as far as it fits; the driver sees at most one row per pattern and power.
    """
    spark = members.sparkSession
    plan = []
    for p, n in taken.items():
        times = min(n // sizes[p], REPEATS) if sizes[p] else 0
        plan.append((list(p), int(times), int(n - times * sizes[p]) if times < REPEATS else 0))
    plan_rows = spark.createDataFrame(plan, "pattern array<string>, times long, rest long")
    seeded = F.xxhash64(F.lit(SEED), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("size"))
    rows = members.withColumn("seeded", seeded).withColumn("bucket", F.shiftrightunsigned("seeded", 52).cast("int"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("total"))
    sums = sums.select("pattern", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("pattern", "bucket").orderBy("seeded", key).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("until", F.sum("size").over(within)).join(sums, ["pattern", "bucket"]).join(plan_rows, "pattern")
    placed = placed.withColumn("until", F.col("until") + F.col("earlier")).withColumn("first", F.col("until") <= F.col("rest"))
    placed = staged(placed.select(*members.columns, "seeded", "times", "rest", "until", "first"), "placed")
    filled = placed.where("first").groupBy("pattern").agg(F.max("until").alias("filled"))
    power = F.floor(F.log2(F.col("size").cast("double"))).alias("power")
    later = placed.where("NOT first AND size > 0").join(filled, "pattern", "left").withColumn("gap", F.expr("rest - coalesce(filled, 0)")).where("size <= gap")
    ones = later.groupBy("pattern", "gap", power).agg(F.min(F.struct("seeded", key, "size")).alias("one"))
    room: dict[tuple, int] = {}
    more = []
    for r in sorted(ones.collect(), key=lambda r: -r.power):
        left = room.setdefault(tuple(r.pattern), r.gap)
        if r.one["size"] <= left:
            room[tuple(r.pattern)] = left - r.one["size"]
            more.append((r.one["seeded"], r.one[key], list(r.pattern)))
    kind = members.schema[key].dataType.simpleString()
    more_rows = spark.createDataFrame(more, f"also_seeded long, also_key {kind}, also_pattern array<string>")
    same = [placed.seeded == more_rows.also_seeded, placed[key].eqNullSafe(more_rows.also_key), placed.pattern == more_rows.also_pattern]
    out = placed.join(more_rows, same, "left")
    return out.select(*members.columns, F.expr("size * (times + CASE WHEN first OR also_seeded IS NOT NULL THEN 1 ELSE 0 END)").alias("taken"))


def mix(docs: DataFrame, sources: Column, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """How many words a mix takes of each document, and the sources' sizes and targets.

    `sources` is an array of names; a document may belong to several, and null or no source is a source
    of its own. The first frame has `key`, pattern, size and taken (repeats counted, at most REPEATS
    times the size), the second pattern name, source, source_size and target. Null and empty texts have
    size 0 and nothing is taken of them. Repeated rows are documents of their own; rows equal in key and
    size are taken alike when they close a gap. Reruns agree: the order is a seeded hash of key and size.
    """
    spark = docs.sparkSession
    members = staged(docs.select(key, _pattern(sources).alias("pattern"), n_words(F.col(text)).alias("size")), "members")
    sums = members.groupBy("pattern").agg(F.sum("size").alias("n")).limit(MOST_PATTERNS + 1).collect()
    if len(sums) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns; merge sources first")
    sizes = {tuple(r.pattern): r.n for r in sums}
    of_source: dict[str | None, int] = defaultdict(int)
    for p, n in sizes.items():
        for name in p:
            of_source[_source(name)] += n
    goal = targets(list(of_source.items()), sum(sizes.values()))
    patterns = {p: tuple(_source(name) for name in p) for p in sizes}
    flow = flows({patterns[p]: n for p, n in sizes.items()}, {s: round(t) for s, t in goal.items()})
    taken: dict[tuple, int] = defaultdict(int)
    for (p, _), n in flow.items():
        taken[p] += n
    picked = _pick(members, {p: taken[patterns[p]] for p in sizes}, sizes, key)
    named = [(NULL_SOURCE if s is None else "1" + s, s, of_source[s], goal[s]) for s in of_source]
    return picked, spark.createDataFrame(named, "name string, source string, source_size long, target double")


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix of documents of one source each: key, size, source_size, target and taken."""
    picked, goals = mix(docs, F.array(source), key, text)
    return picked.withColumn("name", F.col("pattern")[0]).join(goals, "name").select(key, "size", "source_size", "target", "taken")

"""A Merkle manifest of a dataset, with a proof for every row, from range-sorted partitions (operator 11).

Rows are sorted by group and id into ranges. How many rows of each group every partition holds tells each partition where its rows stand in their group, so it builds
all aligned subtrees whose leaves it holds, alone. The nodes at its ragged edges, at most fan - 1 on either side of a level, are shuffled by the coordinate (group, level,
index) of their ancestor some levels above and finish the levels up to it, then those above that; the subroots of all groups are leaves of one more such tree. Then the upper parts of the paths go down again to the
partitions that sent the nodes, which put the lower parts in front of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import shared_dir, stored
from .resampling import CRC_TABLE_SQL, crc_sql

DIGITS = 64  # of a digest in hex
#: Levels that one shuffle of ragged nodes finishes: all below one node of the level above them, so at most fan**BAND nodes of a level meet in a task.
BAND = 4


def _digest(children: Sequence[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def record(*columns: str) -> Column:
    """The digest of a row: of its columns one after another, each ``-`` if null, else its bytes in UTF-8, ``:`` and its value."""
    text = [F.col(c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def fold(leaf: Column, places: Column, siblings: Column) -> Column:
    """The root that follows from a leaf and its path."""
    step = lambda own, s: F.sha2(F.concat(F.substring(s["siblings"], F.lit(1), s["places"] * DIGITS), own, F.substring(s["siblings"], s["places"] * DIGITS + 1, F.length(s["siblings"]))), 256)
    return F.aggregate(F.arrays_zip(places.alias("places"), siblings.alias("siblings")), leaf, step)


def _finish(nodes: Iterable[tuple[int, int, int, str, int | None]], low: int, fan: int) -> dict[int, dict[int, tuple[int, str, int | None]]]:
    """Of nodes (level, index, level's size, digest, partition) below one node of level low + BAND: {level: {index: (size, digest, partition)}}, with all levels up to that node, or to the root."""
    levels: dict[int, dict] = {}
    for level, index, size, digest, part in nodes:
        levels.setdefault(level, {})[index] = size, digest, part
    for level in range(low, low + BAND):
        own = levels.get(level, {})
        if not own:
            continue
        size = next(iter(own.values()))[0]
        if size == 1:
            break
        for parent, run in groupby(sorted(own), key=lambda i: i // fan):
            levels.setdefault(level + 1, {})[parent] = -(-size // fan), _digest([own[i][1] for i in run]), None
    return levels


def _climb(leaves: list[str], start: int, total: int, fan: int) -> list[tuple[int, int, list[str], int, int]]:
    """Of leaves start, start + 1, ... of a group of total leaves, level by level: first index, the level's size in the group, the nodes, and which of them
    (from, to) have their parent built here too."""
    levels, first, size, nodes = [], start, total, leaves
    while True:
        end = first + len(nodes)
        low, high = -(-first // fan), -(-end // fan) if end == size else end // fan
        if size == 1 or low >= high:
            levels.append((first, size, nodes, 0, 0))
            return levels
        done = min(high * fan, end) - first
        levels.append((first, size, nodes, low * fan - first, done))
        nodes = [_digest(nodes[i : i + fan]) for i in range(low * fan - first, done, fan)]
        first, size = low, -(-size // fan)


def _others(children: Sequence[str], at: int) -> str:
    return "".join(children[:at]) + "".join(children[at + 1 :])


def forest(ranged: RDD, fan: int) -> tuple[RDD, RDD]:
    """Trees over an RDD of (group, leaf, row) whose partitions are sorted by group and place. Gives (group, root) of each group, and a function as ``prove``.

    prove(tails): from (group, (places, siblings, anything)) above each root, (row, leaf, places, siblings, anything) for each leaf.
    """
    parts = ranged.getNumPartitions()
    upper = max(1, parts // 8)
    blocks = ranged.mapPartitionsWithIndex(lambda i, rows: [(i, [(g, [(leaf, row) for _, leaf, row in run]) for g, run in groupby(rows, key=lambda r: r[0])])], preservesPartitioning=True)
    blocks.checkpoint()

    def offsets(counts: tuple) -> Iterator[tuple]:
        group, sizes = counts
        total, before = sum(n for _, n in sizes), 0
        for i, n in sorted(sizes):
            yield i, (group, before, total)
            before += n

    counts = blocks.flatMap(lambda b: [(g, (b[0], len(run))) for g, run in b[1]]).groupByKey(upper)
    totals = counts.map(lambda c: sum(n for _, n in c[1]))
    most = totals.fold(0, max)
    placed = blocks.zip(_home(counts.flatMap(offsets), parts))

    def ragged(block: tuple) -> Iterator[tuple]:
        (i, runs), starts = block
        starts = {g: (start, total) for g, start, total in starts}
        for group, run in runs:
            for level, (first, size, nodes, low, high) in enumerate(_climb([leaf for leaf, _ in run], *starts[group], fan)):
                for at in (*range(low), *range(high, len(nodes))):
                    yield level, group, first + at, size, nodes[at], i

    edges = placed.flatMap(ragged)
    roots = edges.filter(lambda e: e[3] == 1).map(lambda e: (e[1], (e[4], e[0], e[5])))
    wide = fan**BAND
    families, built, low = [], None, 0
    while most > 1:
        inside = lambda e, low=low: low <= e[0] < low + BAND and e[3] > 1
        nodes = edges.filter(inside).map(lambda e, low=low: ((e[1], e[2] // fan ** (low + BAND - e[0])), (e[0], e[2], e[3], e[4], e[5])))
        if built is not None:
            nodes = nodes.union(built)
        family = nodes.groupByKey(upper)
        families.append(family)

        def top(x: tuple, low: int = low) -> Iterator[tuple]:
            levels = _finish(x[1], low, fan)
            level = max(levels)
            for index, (size, digest, _) in levels[level].items():  # one
                yield x[0][0], level, index, size, digest

        above = family.flatMap(top)
        roots = roots.union(above.filter(lambda a: a[3] == 1).map(lambda a: (a[0], (a[4], a[1], None))))
        built = above.filter(lambda a: a[3] > 1).map(lambda a: ((a[0], a[2] // wide), (a[1], a[2], a[3], a[4], None)))
        most, low = -(-most // wide), low + BAND

    def prove(tails: RDD) -> RDD:
        tops = tails.join(roots, upper)  # (group, (tail, (root, level, partition)))
        sent = tops.filter(lambda t: t[1][1][2] is not None).map(lambda t: (t[1][1][2], (t[0], t[1][1][1], 0, t[1][0])))
        going = None
        for band in range(len(families) - 1, -1, -1):
            here = tops.filter(lambda t, low=band * BAND: t[1][1][2] is None and low < t[1][1][1] <= low + BAND).map(lambda t: ((t[0], 0), t[1][0]))
            here = here if going is None else here.union(going)

            def down(x: tuple, low: int = band * BAND) -> Iterator[tuple]:
                (group, _), (nodes, tail) = x
                levels = _finish(nodes, low, fan)
                level = max(levels)
                above = {index: tail for index in levels[level]}
                for level in range(level - 1, low - 1, -1):
                    own, tails = levels.get(level, {}), {}
                    for index, (_, _, part) in own.items():
                        begin = index // fan * fan
                        digests = [own[i][1] for i in range(begin, begin + fan) if i in own]
                        places, siblings, more = above[index // fan]
                        tails[index] = [index - begin, *places], [_others(digests, index - begin), *siblings], more
                        if part is not None or level == low:
                            yield part, (group, level, index, tails[index])
                    above = tails

            children = families[band].join(here, upper).flatMap(down)
            sent = sent.union(children.filter(lambda c: c[0] is not None))
            going = children.filter(lambda c: c[0] is None).map(lambda c: ((c[1][0], c[1][2]), c[1][3]))

        def finish(block: tuple) -> Iterator[tuple]:
            ((_, runs), starts), tails = block
            starts, known = {g: (start, total) for g, start, total in starts}, {}
            for group, level, index, tail in tails:
                known[group, level, index] = tail
            for group, run in runs:
                levels = _climb([leaf for leaf, _ in run], *starts[group], fan)
                above: list = []
                for level in range(len(levels) - 1, -1, -1):
                    first, _, nodes, low, high = levels[level]
                    here = []
                    for at in range(len(nodes)):
                        if not low <= at < high:
                            here.append(known[group, level, first + at])
                            continue
                        parent, begin = divmod(at - low, fan)
                        children = nodes[low + parent * fan : min(low + parent * fan + fan, high)]
                        places, siblings, more = above[parent]
                        here.append(([begin, *places], [_others(children, begin), *siblings], more))
                    above = here
                for (leaf, row), (places, siblings, more) in zip(run, above):
                    yield row, leaf, places, siblings, more

        return placed.zip(_home(sent, parts)).flatMap(finish)

    return roots.mapValues(lambda r: r[0]), prove


def _home(values: RDD, parts: int) -> RDD:
    """(partition, value) pairs as one list in each partition."""
    return values.partitionBy(parts, lambda i: i).mapPartitions(lambda pairs: [[v for _, v in pairs]])


def merkle_manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", order: str = "doc_id", carry: Sequence[str] = ("doc_id",), fan: int = 8) -> DataFrame:
    """The columns named in carry, leaf, subroot, root, places and siblings for every row of docs.

    leaf: record(*columns). In each group leaves ascend by ``order`` (null last; rows alike in it by leaf, repeated rows in any order); while several nodes remain,
    every ``fan`` consecutive ones become the SHA-256 of their hex digests, the last run having fewer, even one. The group's last node is its subroot, and subroots in
    the order of their groups (null first, then by bytes) likewise give the root. places and siblings: from the leaf upwards, the node's place in its run and
    the run's other digests, one after another; fold() leads from them to the root. Nulls anywhere are values of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    leaves = stored(docs.select(F.col(group).cast("string").alias("group"), F.col(order).alias("order"), record(*columns).alias("leaf"), row.alias("row")), "leaves")
    keys = [F.col("group").asc_nulls_first(), F.col("order").asc_nulls_last(), F.col("leaf"), F.col("tie")]
    ranged = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    trees, prove = forest(ranged.select("group", "leaf", "row").rdd.map(lambda r: (r[0], r[1], tuple(r[2]))), fan)
    # one leaf a group; its row is the group
    tops = trees.sortBy(lambda t: (t[0] is not None, (t[0] or "").encode()), numPartitions=max(1, n // 8)).map(lambda t: ("", t[1], t[0]))
    top, prove_top = forest(tops, fan)
    tails = prove_top(top.map(lambda r: (r[0], ([], [], r[1])))).map(lambda r: (r[0], (r[2], r[3], (r[1], r[4]))))
    rows = prove(tails).map(lambda r: (r[0], r[1], *r[4], r[2], r[3]))
    kind = leaves.schema["row"].dataType.simpleString()
    out = spark.createDataFrame(rows, f"row {kind}, leaf string, subroot string, root string, places array<int>, siblings array<string>", verifySchema=False)
    return out.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(carry)], "leaf", "subroot", "root", "places", "siblings")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as leaves, with every third id's text tampered with and folded along its proof."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    docs = docs.select("doc_id", "source", "lang", "n_chars", "text").withColumn("changed", F.translate("text", letters, letters.lower()))
    docs = docs.withColumn("other", F.when(tampered, record("doc_id", "source", "lang", "n_chars", "changed")))
    found = merkle_manifest(docs, carry=["doc_id", "other"])
    folded = fold(F.coalesce("other", "leaf"), F.col("places"), F.col("siblings"))
    out = found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _record_sql(text: str) -> str:
    fields = [f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
leaves AS (
  SELECT doc_id, lang, {_record_sql('text')} AS leaf, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n,
         CASE WHEN {crc_sql('hex(encode(doc_id::VARCHAR))')} % 3 = 0 THEN {_record_sql(LOWER_SQL)} ELSE {_record_sql('text')} END AS shown
  FROM documents, crc_table
),
nodes(lang, level, place, n, digest) AS (
  SELECT lang, 0, place, n, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, place // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY place)) FROM nodes WHERE n > 1 GROUP BY lang, level, place // 8
),
subroots AS (SELECT lang, level AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
above(level, place, n, digest) AS (
  SELECT 0, place, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY place)) FROM above WHERE n > 1 GROUP BY level, place // 8
),
-- both kinds of trees under one name; level counts on from a group's subroot
runs AS (
  SELECT n.lang, n.level, n.place, n.digest FROM nodes n WHERE n.n > 1
  UNION ALL
  SELECT s.lang, s.height + a.level, a.place, a.digest FROM subroots s, above a WHERE a.n > 1
),
-- where each leaf's own nodes stand
own(doc_id, lang, leaf, shown, level, place, height, seat) AS (
  SELECT doc_id, l.lang, leaf, shown, 0, CASE WHEN height = 0 THEN s.place ELSE l.place END, height, s.place FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT doc_id, lang, leaf, shown, level + 1, CASE WHEN level + 1 = height THEN seat ELSE place // 8 END, height, seat FROM own WHERE level < 40
),
beside AS (
  SELECT doc_id, o.level, o.place AS mine, string_agg(r.digest, '' ORDER BY r.place) FILTER (r.place < o.place) AS before, string_agg(r.digest, '' ORDER BY r.place) FILTER (r.place > o.place) AS after
  FROM own o JOIN runs r ON o.lang IS NOT DISTINCT FROM r.lang AND o.level = r.level AND o.place // 8 = r.place // 8
  GROUP BY doc_id, o.level, o.place
),
paths AS (SELECT doc_id, list(struct_pack(before := coalesce(before, ''), after := coalesce(after, '')) ORDER BY level) AS steps FROM beside GROUP BY doc_id),
folded(doc_id, level, digest) AS (
  SELECT doc_id, 0, shown FROM leaves
  UNION ALL
  SELECT f.doc_id, level + 1, sha256(steps[level + 1].before || digest || steps[level + 1].after) FROM folded f JOIN paths p ON f.doc_id = p.doc_id WHERE level < len(steps)
)
SELECT l.doc_id, leaf, subroot, root, sha256(coalesce(list_reduce(list_transform(steps, lambda s: s.before || s.after), lambda a, b: a || b), '')) AS proof_sha256,
       f.digest AS folded_root, f.digest = root AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang CROSS JOIN (SELECT digest AS root FROM above WHERE n = 1)
LEFT JOIN paths p ON p.doc_id = l.doc_id JOIN folded f ON f.doc_id = l.doc_id AND f.level = coalesce(len(steps), 0)
"""

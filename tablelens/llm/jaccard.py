"""Jaccard joins of shingle sets by a token-group matrix.

Equal sets are one node.  Nodes are partitioned into groups of similar ones by their smallest
shingle hashes; inside a group each member is compared with the group's leaders, so a cluster of n
near copies costs about n comparisons and is already connected.  A group is then known by the
union of its members' shingles.  A set can only link into a group if some of its rarest shingles are
among the group's rarest, and if its overlap with the group's union can reach the bound; only
such groups are opened and their members compared exactly.  Components of the links are found
by Spark rounds.

All comparisons are exact on 64-bit shingle hashes.  The order "rarest first" is any fixed order as
far as results go; it comes from counts of all shingles in a table of fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import (
    FILTER_BITS, filter_bitmap, has_bit, hash_bits, prepared, rolling_hashes, text_key, texts, word_hashes,
)
from tablelens.llm.components import components
from tablelens.plans.runtime import written

#: Members of a group that are compared in one task, and queries that one copy of a group answers.
GROUP = 128
QUERIES = 1024
#: Counters of the shingle counts (fixed; 8 bytes each), and blocks in which they are summed.
COUNTERS = 1 << 20
BLOCKS = 64
#: Rare shingles that two linking sets must share (fewer only if their least overlap is smaller).
COMMON = 3
#: Rare shingles that a task gathers before it hands them out, and characters of text per hash range.
CHUNK = 1 << 18
RANGE_CHARS = 1 << 25
NO_ID = np.iinfo(np.int64).max
#: Nodes that may share a rare shingle before it only pairs sets that can still reach the bound from there on.
HOT = 64
#: Places beyond are written as this one, which only makes bounds looser.
FAR = (1 << 16) - 1
#: Set sizes up to this one are classes of their own; above, a class is about a fiftieth of its sizes wide.
EXACT_SIZES = 64


def shingles(text: str, width: int) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    words = word_hashes(text, lower=True)
    return np.unique(rolling_hashes(words, min(width, len(words)))) if len(words) else words


def least_overlap(n, m, percent: int):
    """The smallest intersection of sets of n and m with which 100 * i >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    """Linking sets share their first elements, in whatever order: min(COMMON, least overlap) of them are
    among this many first ones of each."""
    least = -(-percent * n // 100)
    return n - least + min(COMMON, least)


def shingle_counts(rows: DataFrame, width: int) -> np.ndarray:
    """How many (document, shingle) pairs fall on each counter: COUNTERS numbers, whatever the input."""
    size = COUNTERS // BLOCKS

    def counted(batches):
        total = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = shingles(text, width) >> np.uint64(44)
                np.add.at(total, found.astype(np.int64), np.uint32(1))
        packs = [total[i * size : (i + 1) * size].tobytes() for i in range(BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(packs, pa.binary())], ["block", "packed"])

    def summed(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.uint64)
        for p in table.column("packed").to_pylist():
            total += np.frombuffer(p, np.uint32)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "packed": pa.array([total.tobytes()], pa.binary())})

    parts = prepared(rows).select("text").mapInArrow(counted, "block int, packed binary")
    found = parts.groupBy("block").applyInArrow(summed, "block int, packed binary").collect()
    weights = np.zeros(COUNTERS, np.uint64)
    for row in found:  # BLOCKS rows
        weights[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(bytes(row["packed"]), np.uint64)
    return weights


DOCUMENT, TOKEN = 0, 1
_MATRIX = "kind int, value long, node long, n long, h1 long, h2 long, key long"


class _Chunk:
    """Sets of consecutive documents of one task: who they are, and the rarest shingles of each node once."""

    def __init__(self, ranges: int):
        self.ranges = ranges
        self.reset()

    def reset(self):
        self.documents, self.nodes, self.tokens, self.n = [], {}, [], 0

    def add(self, doc_id: int, key: int, found: np.ndarray, prefix):
        import xxhash

        n = len(found)
        signed = found.view(np.int64)
        node = xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63) if n else 0
        self.documents.append((doc_id, node, n, int(signed[0]) if n else 0, int(signed[min(1, n - 1)]) if n else 0, key))
        if n and node not in self.nodes:
            self.nodes[node] = n
            self.tokens.append(prefix(found))
            self.n += len(self.tokens[-1])
        return self.n >= CHUNK or len(self.documents) >= CHUNK

    def rows(self):
        if self.documents:
            held = np.array(self.documents, "<i8")
            yield int(held[0, 1]) % self.ranges, DOCUMENT, held.tobytes()
        if self.tokens:
            nodes, sizes = np.array(list(self.nodes), np.int64), np.array(list(self.nodes.values()), np.int64)
            owners = np.repeat(np.arange(len(nodes)), [len(t) for t in self.tokens])
            tokens = np.concatenate(self.tokens)
            places = np.concatenate([np.arange(len(t)) for t in self.tokens])
            order = np.argsort(tokens)
            tokens, owners, places = tokens[order], owners[order], np.minimum(places[order], FAR).astype("<u2")
            part = ((tokens >> np.uint64(32)) * np.uint64(self.ranges) >> np.uint64(32)).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(self.ranges + 1))
            for k in range(self.ranges):
                a, b = cuts[k], cuts[k + 1]
                if a < b:
                    used, local = np.unique(owners[a:b], return_inverse=True)
                    head = np.array([b - a, len(used)], "<u4")
                    parts = (head, nodes[used], sizes[used].astype("<u4"), tokens[a:b].astype("<u8"), local.astype("<u4"), places[a:b])
                    yield k, TOKEN, b"".join(x.tobytes() for x in parts)
        self.reset()


def _unpacked(data: bytes):
    """Tokens, nodes, set sizes and places in the order of rarity."""
    n, m = np.frombuffer(data, "<u4", 2).tolist()
    nodes, sizes = np.frombuffer(data, "<i8", m, 8), np.frombuffer(data, "<u4", m, 8 + 8 * m)
    tokens, local = np.frombuffer(data, "<u8", n, 8 + 12 * m), np.frombuffer(data, "<u4", n, 8 + 12 * m + 8 * n)
    places = np.frombuffer(data, "<u2", n, 8 + 12 * m + 12 * n)
    return tokens, nodes[local], sizes[local].astype(np.int64), places.astype(np.int64)


def matrix(rows: DataFrame, width: int, percent: int, weights) -> DataFrame:
    """Rows of two kinds: each document (its id, node, set size, two smallest hashes, text key), and each rare
    shingle of a node that is a rare shingle of another node too (token, node, set size, in h1 its place in the node's
    order of rarity, in h2 whether more than HOT nodes have it)."""
    chars = rows.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).head()[0]
    ranges = max(16, -(-chars // RANGE_CHARS))
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("packed", pa.binary())])
    out = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("value", "node", "n", "h1", "h2", "key")]])

    def prefix(found: np.ndarray) -> np.ndarray:
        order = np.lexsort((found, weights.value[(found >> np.uint64(44)).astype(np.int64)]))
        return found[order[: prefix_size(len(found), percent)]]

    def sign(batches):
        chunk = _Chunk(ranges)

        def batch():
            held = list(chunk.rows())
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            ids = b.column(0).cast(pa.int64()).fill_null(NO_ID).to_pylist()
            for doc_id, text, key in zip(ids, b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if chunk.add(doc_id, key, shingles(text, width), prefix):
                    yield batch()
        if chunk.documents:
            yield batch()

    def shared(table: pa.Table) -> pa.Table:
        kinds, packs = table.column("kind").to_pylist(), table.column("packed")
        documents = [np.frombuffer(packs[i].as_py(), "<i8").reshape(-1, 6) for i, k in enumerate(kinds) if k == DOCUMENT]
        found = []
        if documents:
            held = np.concatenate(documents)
            none = held[:, 0] == NO_ID
            found.append([np.full(len(held), DOCUMENT), pa.array(held[:, 0], pa.int64(), mask=none), *held[:, 1:].T])
        parts = [_unpacked(packs[i].as_py()) for i, k in enumerate(kinds) if k == TOKEN]
        if parts:
            tokens, nodes, sizes, places = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((nodes, tokens))
            tokens, nodes, sizes, places = tokens[order], nodes[order], sizes[order], places[order]
            first = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])))
            tokens, nodes, sizes, places = tokens[first], nodes[first], sizes[first], places[first]
            starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            several = np.diff(np.append(starts, len(tokens)))
            several = np.repeat(several, several)
            keep = several > 1
            if keep.any():
                none = np.zeros(int(keep.sum()), np.int64)
                found.append([none + TOKEN, tokens[keep].view(np.int64), nodes[keep], sizes[keep], places[keep], several[keep] > HOT, none])
        tables = [pa.table([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out) for columns in found]
        return pa.concat_tables(tables) if tables else out.empty_table()

    packs = prepared(rows).select("doc_id", "text", text_key().alias("key")).mapInArrow(sign, "part int, kind int, packed binary")
    return packs.groupBy("part").applyInArrow(shared, _MATRIX)


def wanted_sets(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, set) of the wanted nodes (and a few more); a set as its sorted hashes.

    Texts are dropped by a fixed-size filter of ids, sets by one of nodes, both in one Python operator:
    two in a row would be two Python workers in each task, and all sets would pass between them.
    """
    import xxhash

    context = rows.sparkSession.sparkContext
    ids, hashes = context.broadcast(filter_bitmap(wanted, "least")), context.broadcast(filter_bitmap(wanted, "node", hashed=True))
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary())])

    def sets(batches):
        for batch in batches:
            if batch.num_rows:
                mine = batch.filter(pa.array(has_bit(ids.value, batch.column(1).to_numpy())))
                found = [shingles(t, width).tobytes() for t in mine.column(0).to_pylist()]
                nodes = np.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in found], np.int64)
                near = np.flatnonzero(has_bit(hashes.value, hash_bits(nodes)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes[near]), pa.array([found[i] for i in near], pa.binary())], schema=schema)

    bit = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(int(NO_ID)))), F.lit(FILTER_BITS)).cast("int")
    return prepared(rows).select("text", bit.alias("bit")).mapInArrow(sets, "node long, set binary")


def sets_of(rows: DataFrame, nodes: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """``members`` with their sets, which are taken from the texts each time: kept, they would need more room than the texts.

    Other nodes' texts and sets are dropped by fixed-size filters before the shuffle.
    """
    wanted = nodes.join(members.select("node"), "node", "left_semi")
    return members.join(wanted_sets(rows, wanted, width), "node")


def as_set(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    least = least_overlap(len(a), len(b), percent)
    if min(len(a), len(b)) < least:
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum()) >= least


def follow_leaders(nodes: DataFrame, rows: DataFrame, keys: list[str], width: int, percent: int) -> DataFrame:
    """(node, leader): members of a group that link to an earlier member without a leader of its own.

    Groups are the nodes with equal ``keys``; a group of more than GROUP is cut by a hash of the node.
    """
    keyed = nodes.select("node", F.xxhash64(*keys).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / F.lit(GROUP)).cast("long")
    cut = written(keyed.join(sizes, "key").select("node", "key", F.pmod(F.xxhash64("node"), parts).alias("part")), "groups")
    schema = pa.schema([("node", pa.int64()), ("leader", pa.int64())])

    def follow(table: pa.Table) -> pa.Table:
        held = dict(zip(table.column("node").to_pylist(), table.column("set").to_pylist(), strict=True))
        leaders, pairs = [], []
        for node, data in sorted(held.items()):
            mine = as_set(data)
            for other, theirs in leaders:
                if linked(mine, theirs, percent):
                    pairs.append((node, other))
                    break
            else:
                leaders.append((node, mine))
        return pa.table([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], schema=schema)

    return sets_of(rows, nodes, cut, width).groupBy("key", "part").applyInArrow(follow, "node long, leader long")


def open_groups(asked: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between labels, enough to connect all that link.

    ``asked`` holds, per copy of a group (block, copy), its members and the sets that ask it.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def answer(table: pa.Table) -> pa.Table:
        held = list(zip(*[table.column(n).to_pylist() for n in ("asks", "node", "label", "set")], strict=True))
        members = {node: (label, as_set(data)) for asks, node, label, data in held if not asks}
        labels, found, links = np.array([x[0] for x in members.values()], np.int64), {}, []

        def root(x):
            while found.get(x, x) != x:
                x = found[x]
            return x

        if members:
            sizes = np.array([len(x[1]) for x in members.values()])
            tokens = np.concatenate([x[1] for x in members.values()])
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], np.repeat(np.arange(len(sizes)), sizes)[order]
            union = np.unique(tokens)
            for label, data in {(label, data) for asks, _, label, data in held if asks}:
                mine = as_set(data)
                at = np.searchsorted(union, mine)
                at[at == len(union)] = 0
                # the matrix' bound: no member shares more than the group's union does
                if int((union[at] == mine).sum()) < least_overlap(len(mine), int(sizes.min()), percent):
                    continue
                low, high = np.searchsorted(tokens, mine, "left"), np.searchsorted(tokens, mine, "right")
                spans = [owners[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True) if a < b]
                shared = np.bincount(np.concatenate(spans), minlength=len(sizes))
                for other in np.unique(labels[shared >= least_overlap(len(mine), sizes, percent)]).tolist():
                    x, y = root(label), root(other)
                    if x != y:
                        found[max(x, y)] = min(x, y)
                        links.append((label, other))
        return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], schema=schema)

    return asked.groupBy("block", "copy").applyInArrow(answer, "a long, b long")


def similar_classes(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are runs of non-white-space, A-Z lower-cased; a set holds the distinct ``width``-word
    shingles (all words as one, when fewer).  Two rows link when 100 * intersection >=
    ``percent`` * union; component_id is the smallest doc_id reachable.  Null and empty texts have no
    shingles and link with nothing; null ids never name a component while another is there;
    repeated rows share their class; an empty table gives no rows.
    """
    documents, classes, rooted = rooted_nodes(docs, width, percent, doc_id, text)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("node", "component_id")
    named = classes.join(named, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    answers = documents.filter("n > 0").select("doc_id", "n", "node").join(named, "node")
    answers = answers.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = documents.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return answers.unionByName(alone)


def rooted_nodes(docs: DataFrame, width: int, percent: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, key, node, n), all nodes (node, least id), and the component (node, root, least id) of those that may link."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    rows = texts(docs, doc_id, text)
    weights = docs.sparkSession.sparkContext.broadcast(shingle_counts(rows, width))
    found = written(matrix(rows, width, percent, weights), "matrix")
    documents = found.filter(F.col("kind") == DOCUMENT).select(F.col("value").alias("doc_id"), "node", "n", "h1", "h2", "key")
    index = found.filter(F.col("kind") == TOKEN).select(
        F.col("value").alias("token"), "node", "n", (F.col("n") - F.col("h1")).alias("rest"), (F.col("h2") > 0).alias("hot")
    )

    classes = documents.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("h1").alias("h1"), F.min("h2").alias("h2"))
    classes = written(classes, "classes")
    # a set that has too few of its rarest shingles in common with all others links with nothing
    needed = F.least(F.lit(COMMON), F.ceil(F.col("n") * percent / F.lit(100)))
    nodes = index.groupBy("node").agg(F.count(F.lit(1)).alias("shared"), F.min("n").alias("n")).filter(F.col("shared") >= needed)
    nodes = written(nodes.join(classes, "node").select("node", "n", "h1", "h2", F.coalesce("least", F.lit(int(NO_ID))).alias("least")), "nodes")

    labels, leaders = nodes.select("node", F.col("node").alias("label")), nodes.select("node", "h1", "h2", "least")
    for keys in (["h1", "h2"], ["h1"], ["h2"]):
        pairs = written(follow_leaders(leaders, rows, keys, width, percent), "leaders")
        follows = pairs.withColumnsRenamed({"node": "label", "leader": "to"})
        labels = labels.join(follows, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        leaders = written(leaders.join(pairs, "node", "left_anti"), "leaders")
    labels = written(labels.join(nodes.select("node", "n", "h1"), "node"), "labels")

    links = cross_links(index, labels, rows, nodes, width, percent)
    roots = components(links).withColumnsRenamed({"node": "label"})
    rooted = labels.join(roots, "label", "left").select("node", F.coalesce("component", "label").alias("root"))
    rooted = written(rooted.join(classes.select("node", "least"), "node"), "roots")
    return documents, classes, rooted


def grouped(labels: DataFrame) -> DataFrame:
    """(node, label, n, block): groups of at most about GROUP similar nodes.

    Nodes of one label are together; nodes that are alone in theirs join those with the same smallest hash.
    """
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    place = F.when(F.col("size") > 1, F.xxhash64(F.lit(1), "label")).otherwise(F.xxhash64(F.lit(2), "h1"))
    placed = labels.join(sizes, "label").select("node", "label", "n", place.alias("place"))
    totals = placed.groupBy("place").agg(F.count(F.lit(1)).alias("total"))
    parts = F.ceil(F.col("total") / F.lit(GROUP)).cast("long")
    block = F.xxhash64("place", F.pmod(F.xxhash64("node"), parts)).alias("block")
    return placed.join(totals, "place").select("node", "label", "n", block)


def size_class(n: str) -> str:
    return f"int(CASE WHEN {n} <= {EXACT_SIZES} THEN {n} ELSE {EXACT_SIZES} + floor(50 * ln({n} / {EXACT_SIZES}.0)) END)"


def smallest_of(d: str) -> str:
    """No set of a class has fewer elements."""
    return f"bigint(CASE WHEN {d} <= {EXACT_SIZES} THEN {d} ELSE floor({EXACT_SIZES} * exp(({d} - {EXACT_SIZES}) / 50.0)) - 1 END)"


def asking(index: DataFrame, blocks: DataFrame, stats: DataFrame, percent: int) -> DataFrame:
    """(block, node): the groups that a set has to ask, of another label than its own, by the matrix.

    Sets that link share COMMON of their first elements in the order of rarity, and the first one they share stands so near to both
    beginnings that what follows can reach the bound.  An element of few sets pairs them by the first rule.  One of more than
    HOT sets only pairs by the second, under a key of element and both size classes: texts of one template,
    which share most elements but too few of them, have no key in common.
    A set with such an element goes by the second rule alone, as its others may not count up.
    """
    strong = index.groupBy("node").agg(F.max("hot").alias("strong"))
    nodes = blocks.select("node", "block").join(stats.select("block", "size", "only"), "block").join(strong, "node")
    rows = index.select("token", "node", F.col("n").cast("int").alias("n"), F.col("rest").cast("int").alias("rest"), "hot").join(nodes, "node")
    rows = written(rows, "tokens")  # the rows of the token-group matrix that can decide

    def overlap(n: str, m: str) -> str:
        return f"ceil({percent} * ({n} + {m}) / {100 + percent}.0 - 1e-9)"

    # the smaller group's sets ask the larger group
    may_ask = """block <> own and (size > own_size or (size = own_size and block > own)) and coalesce(only <> own_only, true)"""
    mine = [F.col("block").alias("own"), F.col("size").alias("own_size"), F.col("only").alias("own_only")]
    # an element of few sets brings its sets together, HOT at most
    few = rows.filter("not hot").groupBy("token").agg(F.collect_list(F.struct("node", "n", "rest", "strong", "block", "size", "only")).alias("held"))
    meets = f"""y -> y.block <> x.block and (y.size > x.size or (y.size = x.size and y.block > x.block)) and coalesce(y.only <> x.only, true)
        and 100 * y.n >= {percent} * x.n and 100 * x.n >= {percent} * y.n and least(x.rest, y.rest) + {COMMON - 1} >= {overlap("x.n", "y.n")}"""
    asked = f"""array_distinct(transform(filter(held, {meets}), y -> struct(y.block as block, if(x.strong or y.strong, {COMMON}, 1) as weight,
        least({COMMON}, ceil(least(x.n, y.n) * {percent} / 100.0)) as need)))"""
    met = few.select("held", F.explode("held").alias("x")).select(F.col("x.node").alias("node"), F.explode(F.expr(asked)).alias("y")).select("node", "y.*")

    classes = F.expr(f"""explode(sequence({size_class(f"greatest(1, bigint(ceil(n * {percent} / 100.0)))")}, {size_class(f"bigint(floor(n * 100 / {percent}.0))")}))""")
    near = rows.filter("hot").withColumn("mine", F.expr(size_class("n"))).withColumn("other", classes)
    smaller = f"greatest({smallest_of('other')}, bigint(ceil(n * {percent} / 100.0)))"
    near = near.filter(F.expr(f"rest >= {overlap('n', smaller)}"))
    pair = [F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi")]
    sides = near.select("token", "node", "block", "size", "only", "n", "mine", *pair)
    # copies of one text are groups of one label, which do not ask each other: what a key's commonest label has only meets the others
    keys = ["token", "lo", "hi"]
    labelled = sides.filter("only is not null").groupBy(*keys, "only").agg(F.count(F.lit(1)).alias("rows"))
    common = labelled.groupBy(*keys).agg(F.max_by("only", F.struct("rows", "only")).alias("common"))
    sides = sides.join(common, keys, "left").withColumn("usual", F.coalesce(F.col("only") == F.col("common"), F.lit(False)))
    # a set of the lower class meets groups with sets of the higher one, and the other way about
    left = sides.select(*keys, (F.col("mine") == F.col("lo")).alias("at_lo"), F.col("usual").alias("for"), "node", "n", *mine)
    at_lo = F.when(F.col("lo") == F.col("hi"), F.lit(True)).otherwise(F.col("mine") == F.col("hi")).alias("at_lo")
    askers = F.explode(F.when(F.col("usual"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))).alias("for")
    right = sides.select(*keys, at_lo, "usual", "block", "size", "only").distinct().select(*keys, "at_lo", askers, "block", "size", "only")
    hot = left.join(right, [*keys, "at_lo", "for"]).filter(F.expr(may_ask)).select("node", "block", F.lit(COMMON).alias("weight"), F.lit(COMMON).alias("need"))
    counted = met.select("node", "block", "weight", F.col("need").cast("int").alias("need")).unionByName(hot)
    counted = counted.groupBy("node", "block").agg(F.sum("weight").alias("shared"), F.min("need").alias("need"))
    return counted.filter("shared >= need").select("block", "node")


def cross_links(index: DataFrame, labels: DataFrame, rows: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between labels, from the groups that qualify."""
    blocks = written(grouped(labels), "blocks")
    stats = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("size"), F.when(F.min("label") == F.max("label"), F.min("label")).alias("only"))
    stats = written(stats, "stats")
    asks = asking(index, blocks, stats, percent)
    # a group of several labels asks itself
    asks = asks.unionByName(blocks.join(stats.filter("size > 1 and only is null").select("block"), "block").select("block", "node"))
    ask = written(asks, "asked")
    copies = ask.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES)).cast("long").alias("copies"))
    members = blocks.join(copies, "block").select(
        "block", "node", "label", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), F.lit(False).alias("asks")
    )
    askers = ask.join(copies, "block").join(blocks.select("node", "label"), "node")
    askers = askers.select("block", "node", "label", F.pmod(F.xxhash64("node", "block"), "copies").alias("copy"), F.lit(True).alias("asks"))
    asked = written(members.unionByName(askers), "members")
    return open_groups(sets_of(rows, nodes, asked, width), percent).distinct()


def near_duplicates_removed(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, columns as they came: the smallest id (null last), then the smallest text key.

    Rows that share an id but not a text are told apart; of repeated rows one stays; texts without words all stay.
    """
    documents, _, rooted = rooted_nodes(docs, width, percent, doc_id, text)
    rows = documents.filter("n > 0").groupBy("node", "doc_id", "key").agg(F.count(F.lit(1)).alias("copies"))
    rows = written(rows, "rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    firsts = rows.groupBy("node").agg(first).join(rooted.select("node", "root"), "node", "left")
    firsts = firsts.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    firsts = firsts.select(F.col("first.doc_id").alias("__id"), F.col("first.key").alias("__key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key"))
    marks = rows.join(firsts, same, "left").select("doc_id", "key", "copies", F.col("__key").isNotNull().alias("stays"))
    marks = written(marks.filter("not stays or copies > 1"), "marks")

    keyed = docs.withColumn("__text", text_key(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    marked = marks.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "stays")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__key"))
    once = keyed.join(marked.drop("stays"), same, "left_anti").drop("__text")
    again = keyed.join(marked.filter("stays").drop("stays"), same).dropDuplicates(["__id", "__key"]).drop("__text", "__id", "__key")
    return once.unionByName(again)

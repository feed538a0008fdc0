"""Near-duplicate groups by a chosen-path set similarity join.

Texts are sets of word shingles; two link when their Jaccard similarity is at least ``percent`` hundredths, and groups are
connected components.  Equal sets are one point.

A tree branches every point to the ``BRANCHES`` tokens of its set that are smallest under the tree's random order of the
level (the tokens chosen on the way name the node).  A node of at most ``SMALL`` points is compared exhaustively; larger ones
branch again, up to ``DEPTH`` levels.  Similar sets mostly choose a common token at each level, so one tree brings a linked
pair together with probability (1 - (1 - s) ** BRANCHES) ** DEPTH or more; independent trees are repeated to the target recall.
Which nodes are large is known from counts, sent to the tasks as a bitmap of fixed size (a wrong hit only branches once more).

Comparisons first look at sizes and sketches: 512 parities of the set's tokens, whose differing bits never exceed the tokens
that only one set has, and 128 minwise bits (threshold from the binomial tail).  Candidates that pass are decided by their whole sets.  Every point first meets its best mate of each node; once those links
have merged groups, only pairs of different groups are compared further, all of them.  Nodes that stay large at the last
level are cut into bounded runs, then represented by one point per group, and at last the points outside a node's main group are
compared with the whole node, block by block, so a group of copies never forms all its pairs.  There the parities are 2,048, which
leaves few pairs just below the similarity, and of the nodes that two points share only one passes their pair on.  The comparisons
themselves still grow with the square of the points of a large node that stay in different groups.

Missed links: at the similarity itself at most 1 - recall per pair (1e-5 by default) and 1e-7 by sketch, less above it.

Edge cases: no words (NULL or empty text) is an empty set, linked with nothing; fewer words than a shingle are one shingle;
repeated rows share a point; NULL ids never name a group unless all its ids are NULL; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import LOWER_ASCII, byte_texts, slices, stage, text_of, unstage
from .simhash import components
from .substrings import WordHashes, run_hashes

BRANCHES, DEPTH, SMALL = 2, 3, 64
RECALL, SKETCH_MISS = 0.99999, 1e-7
#: words of 64 minwise bits, and words of 64 parities
SKETCH_WORDS, PARITY_WORDS = 2, 8
#: words of parities of the points of large nodes, where near misses would be many
WIDE_WORDS = 32
#: bits of the maps of large nodes and of points whose sets are needed
MAP_BITS, NEEDED_BITS = 2**23, 2**25
#: points that are compared at a time in a node that stays large, points of a block when it is compared as a whole, and most blocks a side
RUN, BLOCK, SIDE = 512, 2048, 16
_MINWISE, _PARITY = [f"s{i}" for i in range(SKETCH_WORDS)], [f"x{i}" for i in range(PARITY_WORDS)]
_SKETCH = _MINWISE + _PARITY
_ROW = "node long, p long, n int, " + ", ".join(f"{s} long" for s in _SKETCH)
_RNG = np.random.default_rng(11)
_ODD = _RNG.integers(0, 2**63, 64 * SKETCH_WORDS + 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def trees_for(percent: int, recall: float = RECALL) -> int:
    """Trees that bring a pair of the similarity together with the probability ``recall``."""
    once = (1 - (1 - percent / 100) ** BRANCHES) ** DEPTH
    return 1 if once >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - once))


def least_agreement(percent: int, miss: float = SKETCH_MISS) -> int:
    """Equal sketch bits that a pair of the similarity falls short of with probability at most ``miss``."""
    bits, p = 64 * SKETCH_WORDS, (1 + percent / 100) / 2
    if p >= 1:
        return bits
    tail = 0.0
    for k in range(bits + 1):
        tail += math.exp(math.lgamma(bits + 1) - math.lgamma(k + 1) - math.lgamma(bits - k + 1) + k * math.log(p) + (bits - k) * math.log1p(-p))
        if tail > miss:
            return k
    return bits


def token_set(words: WordHashes, text: bytes, shingle: int) -> np.ndarray:
    """Distinct hashes of the text's shingles, ascending."""
    h = words.of(text.translate(LOWER_ASCII).split())
    if not len(h):
        return h
    length = min(shingle, len(h))
    return np.unique(run_hashes(h, np.arange(len(h) - length + 1), length, 0))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ _ODD[salt]) * _ODD[salt + 1]
    x ^= x >> np.uint64(32)
    return x * _ODD[salt + 2]


def sketch_of(tokens: np.ndarray) -> np.ndarray:
    """One bit per random order: a bit of the set's smallest token under it."""
    factors = _ODD[: 64 * SKETCH_WORDS, None]
    least = np.full(64 * SKETCH_WORDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(tokens), 2048):
        np.minimum(least, (tokens[None, at : at + 2048] * factors).min(axis=1), out=least)
    return np.packbits((_mixed(least, 0) >> np.uint64(63)).astype(np.uint8), bitorder="little").view("<u8")


def parities_of(tokens: np.ndarray, words: int = PARITY_WORDS) -> np.ndarray:
    """Parities of the numbers of tokens that fall on each of 64 * ``words`` places."""
    places = (_mixed(tokens, 0) >> np.uint64(32)).astype(np.int64) % (64 * words)
    odd = np.bincount(places, minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def chosen_tokens(tokens: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """The BRANCHES smallest tokens under each order; small sets repeat their last one."""
    if len(tokens) > BRANCHES:
        # the order of a token is its mixed product, so that the smallest come out of one partition per order
        keys = _mixed(tokens[None, :] * orders[:, None], 1)
        at = np.argpartition(keys, BRANCHES, axis=1)[:, :BRANCHES]
        return tokens[at]
    return tokens[np.minimum(np.arange(BRANCHES), len(tokens) - 1)][None, :].repeat(len(orders), axis=0)


def _described(texts: DataFrame, shingle: int, trees: int) -> DataFrame:
    """(k, th, h1, h2, n, sketch, chosen) per document; (h1, h2) is the hash of its set."""
    orders = np.random.default_rng(12).integers(0, 2**63, trees * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in slices(batches):
            names, n, sketch, chosen = [], [], [], []
            for text in byte_texts(b, "text"):
                own = token_set(words, text, shingle)
                names.append(xxhash.xxh128_digest(own.tobytes()))
                n.append(len(own))
                sketch.append(sketch_of(own).tobytes() + parities_of(own).tobytes() if len(own) else None)
                chosen.append(chosen_tokens(own, orders).tobytes() if len(own) else None)
            h = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("th"), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(n, pa.int32()),
                 pa.array(sketch, pa.binary()), pa.array(chosen, pa.binary())],
                ["k", "th", "h1", "h2", "n", "sketch", "chosen"])

    return texts.select("k", "th", "text").mapInArrow(
        run, "k long, th long, h1 long, h2 long, n int, sketch binary, chosen binary")


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bytes of a map of ``bits`` bits with the places of all values (modulo ``bits``) set; its size does not grow."""
    at = F.pmod(F.col(column), F.lit(bits))
    parts = df.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    whole = np.zeros(bits // 8 + 4096, np.uint8)
    # bit 0 of the function's first bucket stands for the value 1, that of bucket 0 for 0 and below
    for r in parts.collect():
        own = np.frombuffer(r.map, np.uint8)
        whole[r.part * 4096 : r.part * 4096 + len(own)] = own
    return whole


def _in_bitmap(whole: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    at = values.view(np.int64) % bits
    # the positions that bitmap_bucket_number and bitmap_bit_position give
    part = np.where(at > 0, 1 + (at - 1) // 32768, 0)
    place = np.where(at > 0, (at - 1) % 32768, 0)
    return (whole[part * 4096 + place // 8] >> (place % 8).astype(np.uint8)) & 1 > 0


def _paths(chosen: np.ndarray, maps: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes level by level: (level, row, node, large), from tokens (row, tree, level, branch).

    Only paths through nodes that are large so far go on; the last level given has no map and counts as large.
    """
    rows, trees = chosen.shape[:2]
    row, tree = (x.ravel() for x in np.indices((rows, trees)))
    node = _mixed(tree.astype(np.uint64), 1)
    for level in range(len(maps) + 1):
        tokens = chosen[row, tree, level]
        fresh = np.ones(tokens.shape, bool)
        fresh[:, 1:] = tokens[:, 1:] != tokens[:, :-1]
        node = _mixed(node[:, None] * _ODD[3] + tokens, 2)[fresh]
        row, tree = (np.repeat(x, fresh.sum(axis=1)) for x in (row, tree))
        large = _in_bitmap(maps[level], node, MAP_BITS) if level < len(maps) else np.ones(len(node), bool)
        yield level, row, node, large
        row, tree, node = row[large], tree[large], node[large]


def _tokens(b: pa.RecordBatch, trees: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.column("chosen").to_pylist()), np.uint64).reshape(b.num_rows, trees, DEPTH, BRANCHES)


def _large_nodes(points: DataFrame, trees: int) -> list[np.ndarray]:
    """Maps of the nodes of more than SMALL points, level by level."""
    maps: list[np.ndarray] = []
    for level in range(DEPTH):

        def nodes(batches: Iterator[pa.RecordBatch], known=tuple(maps), level=level) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 2048):
                for at, _, node, _ in _paths(_tokens(b, trees), list(known)):
                    if at == level:
                        yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64))], ["node"])

        sizes = points.select("chosen").mapInArrow(nodes, "node long").groupBy("node").agg(F.count("*").alias("n"))
        maps.append(bitmap(sizes.filter(F.col("n") > SMALL), "node", MAP_BITS))
        if not maps[-1].any():
            break
    return maps


def _placed(points: DataFrame, trees: int, maps: list[np.ndarray]) -> DataFrame:
    """Points in the nodes where their paths end; ``crowd`` marks nodes that are large at the last level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2048):
            sketch = np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.int64).reshape(b.num_rows, len(_SKETCH))
            for level, row, node, large in _paths(_tokens(b, trees), maps[:-1]):
                last = level == len(maps) - 1
                crowd = _in_bitmap(maps[-1], node, MAP_BITS) if last else large
                ends = np.ones(len(node), bool) if last else ~large
                row, node, crowd = row[ends], node[ends], crowd[ends]
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)), b.column("p").take(at), b.column("n").take(at),
                     *[pa.array(sketch[row, i]) for i in range(len(_SKETCH))], pa.array(crowd)],
                    ["node", "p", "n", *_SKETCH, "crowd"])

    return points.select("p", "n", "sketch", "chosen").mapInArrow(run, f"{_ROW}, crowd boolean")


def _whole_nodes(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[pa.Table]:
    """Rows sorted by node as tables of whole nodes, or with ``most`` of whole runs of that many rows."""
    left = None
    for b in batches:
        new = pa.Table.from_batches([b])
        left = new if left is None else pa.concat_tables([left, new])
        if left.num_rows < 8192:
            continue
        if most:
            cut = left.num_rows // most * most
        else:
            node = left.column("node").to_numpy()
            others = np.nonzero(node != node[-1])[0]
            cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield left.slice(0, cut)
            left = left.slice(cut)
    if left is not None and left.num_rows:
        yield left


def _alike(t: pa.Table, percent: int, bits: int, most: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (i, j, less the unequal parities) of rows of one node and run whose sizes and sketches allow the similarity (and whose groups differ)."""
    node, n = t.column("node").to_numpy(), t.column("n").to_numpy().astype(np.int64)
    minwise, parity = ([t.column(s).to_numpy().view(np.uint64) for s in names] for names in (_MINWISE, _PARITY))

    def unlike(words: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int64) for w in words)

    root = t.column("root").to_numpy() if "root" in t.column_names else None
    run = np.arange(len(node)) // most if most else np.zeros(len(node), np.int64)
    near = np.arange(len(node))
    for step in range(1, len(node)):
        near = near[near + step < len(node)]
        near = near[(node[near] == node[near + step]) & (run[near] == run[near + step])]
        if not len(near):
            return
        far = near + step
        ok = 100 * np.minimum(n[near], n[far]) >= percent * np.maximum(n[near], n[far])
        if root is not None:
            ok &= root[near] != root[far]
        i, j = near[ok], far[ok]
        apart = unlike(parity, i, j)
        ok = (100 + percent) * apart <= (100 - percent) * (n[i] + n[j])
        i, j, apart = i[ok], j[ok], apart[ok]
        good = 64 * SKETCH_WORDS - unlike(minwise, i, j) >= bits
        yield i[good], j[good], -apart[good]


def _differing(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Unequal bits of each column of ``many`` and the words ``one``."""
    return np.bitwise_count(many ^ one[:, None]).sum(axis=0, dtype=np.int64)


def _mates(rows: DataFrame, percent: int, bits: int, most: int | None) -> DataFrame:
    """Rows that have a mate in their node, with the best one (``mate``), from rows sorted by node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_nodes(batches, most):
            none = -64 * PARITY_WORDS - 1
            best = np.full(t.num_rows, none, np.int64)
            mate = np.zeros(t.num_rows, np.int64)
            for i, j, same in _alike(t, percent, bits, most):
                # in one step every row is the left one of at most one pair, and the right one of at most one
                for one, other in ((i, j), (j, i)):
                    better = same > best[one]
                    best[one[better]], mate[one[better]] = same[better], other[better]
            found = np.nonzero(best > none)[0]
            out = t.take(pa.array(found)).append_column("mate", t.column("p").take(pa.array(mate[found])))
            yield from out.select([*columns, "mate"]).combine_chunks().to_batches()

    columns = ["node", "p", "n", *_SKETCH]
    return rows.mapInArrow(run, f"{_ROW}, mate long")


def _open_pairs(rows: DataFrame, percent: int, bits: int) -> DataFrame:
    """All pairs (a, b) of different groups within nodes that sizes and sketches allow, from rows sorted by node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_nodes(batches, None):
            p = t.column("p").to_numpy()
            for i, j, _ in _alike(t, percent, bits, None):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p[i], p[j])), pa.array(np.maximum(p[i], p[j]))], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def _by_node(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node", "p")


def _in_runs(rows: DataFrame) -> DataFrame:
    """Rows of large nodes over many partitions, a node's points in one random order everywhere."""
    return rows.withColumn("_h", F.xxhash64("p")).repartitionByRange("node", "_h").sortWithinPartitions("node", "_h").drop("_h")


def _needed_sets(texts: DataFrame, points: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """(p, tokens): the sets of the needed points, from one text each; a bitmap keeps other texts from being split."""
    heads = stage(points.join(needed, "p", "left_semi").select("p", "k", "th"), "heads")
    key = F.xxhash64("k", "th")
    wanted = bitmap(heads.select(key.alias("h")), "h", NEEDED_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in slices(batches):
            b = b.filter(pa.array(_in_bitmap(wanted, b.column("h").to_numpy(), NEEDED_BITS)))
            sets = [token_set(words, t, shingle).tobytes() for t in byte_texts(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("th"), pa.array(sets, pa.binary())], ["k", "th", "tokens"])

    found = texts.select("k", "th", key.alias("h"), "text").mapInArrow(run, "k long, th long, tokens binary")
    own = found.join(heads, ["k", "th"]).groupBy("p").agg(F.first("tokens").alias("tokens"))
    sets = stage(own, "sets")
    unstage(heads)
    return sets


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            alike = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    both = pairs.join(sets.select(F.col("p").alias("b"), F.col("tokens").alias("y")), "b")
    both = both.join(sets.select(F.col("p").alias("a"), F.col("tokens").alias("x")), "a")
    return stage(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")


def _paired(mates: DataFrame) -> DataFrame:
    return mates.select(F.least("p", "mate").alias("a"), F.greatest("p", "mate").alias("b")).distinct()


def _grouped(rows: DataFrame, roots: DataFrame) -> DataFrame:
    named = rows.join(roots.select(F.col("node").alias("p"), "root"), "p", "left")
    return named.withColumn("root", F.coalesce("root", "p"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Groups after more links."""
    return roots if links.isEmpty() else components(roots.toDF("a", "b").unionByName(links))


def _marked(sets: DataFrame) -> DataFrame:
    """(p, marks): the parities of sets on WIDE_WORDS words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            marks = [parities_of(np.frombuffer(t, np.uint64), WIDE_WORDS).tobytes() for t in b.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("p"), pa.array(marks, pa.binary())], ["p", "marks"])

    return sets.mapInArrow(run, "p long, marks binary")


def _crowd_pairs(crowd: DataFrame, sets: DataFrame, percent: int, bits: int) -> DataFrame:
    """Pairs of different groups in large nodes, each once: the points outside the main group of each node against all its points."""
    sizes = crowd.groupBy("node", "root").agg(F.count("*").alias("c"))
    main = sizes.groupBy("node").agg(
        F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("groups"), F.sum("c").alias("c")).filter("groups > 1")
    down, across = (F.least(F.ceil(c / BLOCK), F.lit(SIDE)).cast("int") for c in (F.col("c"), F.col("c") - F.col("m.c")))
    main = main.select("node", F.col("m.root").alias("main"), down.alias("n_down"), across.alias("n_across"))
    points = crowd.groupBy("p").agg(F.collect_set("node").alias("nodes")).join(_marked(sets), "p")
    own = stage(crowd.select("node", "p", "n", "root", *_MINWISE).join(main, "node").join(points, "p"), "crowd")
    # a node is a rectangle of blocks: its points by rows, those outside the main group by columns
    place, every = "cast(pmod(xxhash64(p), n_{0}) as int)", "explode(sequence(0, n_{0} - 1))"
    rows = own.withColumn("down", F.expr(place.format("down"))).withColumn("across", F.expr(every.format("across")))
    rest = own.filter("root <> main").withColumn("across", F.expr(place.format("across"))).withColumn("down", F.expr(every.format("down")))

    def described(t: pa.Table) -> tuple[np.ndarray, ...]:
        p, n, root, main = (t.column(c).to_numpy() for c in ("p", "n", "root", "main"))
        marks = np.frombuffer(b"".join(t.column("marks").to_pylist()), np.uint64).reshape(-1, WIDE_WORDS // PARITY_WORDS, PARITY_WORDS)
        minwise = np.stack([t.column(s).to_numpy().view(np.uint64) for s in _MINWISE])
        # parities on fewer words are those on more words, folded
        return p, n.astype(np.int64), root, root == main, np.bitwise_xor.reduce(marks, axis=1).T.copy(), marks.reshape(-1, WIDE_WORDS).T, minwise

    def met(key: tuple, one: pa.Table, other: pa.Table) -> pa.Table:
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if one.num_rows and other.num_rows:
            one = one.sort_by("n")
            p, n, root, inside, few, many, minwise = described(one)
            p_, n_, root_, _, few_, many_, minwise_ = described(other)
            first, last = np.searchsorted(n, -(-percent * n_ // 100)), np.searchsorted(n, 100 * n_ // percent, "right")
            for j in range(other.num_rows):
                span = slice(first[j], last[j])
                most = (100 - percent) * (n[span] + n_[j])
                at = np.nonzero((100 + percent) * _differing(few[:, span], few_[:, j]) <= most)[0] + first[j]
                # of two points outside the main group the pair is met twice and kept once
                at = at[(root[at] != root_[j]) & (inside[at] | (p[at] < p_[j]))]
                at = at[(100 + percent) * _differing(many[:, at], many_[:, j]) <= (100 - percent) * (n[at] + n_[j])]
                at = at[64 * SKETCH_WORDS - _differing(minwise[:, at], minwise_[:, j]) >= bits]
                if len(at):
                    left.append(at)
                    right.append(np.full(len(at), j))
        i, j = np.concatenate(left), np.concatenate(right)
        if not len(i):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        # of all the nodes that two points share, one counts
        nodes = zip(one.column("nodes").take(pa.array(i)).to_pylist(), other.column("nodes").take(pa.array(j)).to_pylist())
        here = np.array([min(set(x).intersection(y)) for x, y in nodes]) == key[0].as_py()
        i, j = p[i[here]], p_[j[here]]
        return pa.table({"a": np.minimum(i, j), "b": np.maximum(i, j)})

    cell = ["node", "down", "across"]
    found = stage(rows.groupBy(*cell).cogroup(rest.groupBy(*cell)).applyInArrow(met, "a long, b long"), "met")
    unstage(own)
    return found


def _roots(texts: DataFrame, points: DataFrame, shingle: int, percent: int, trees: int) -> DataFrame:
    """(node, root) of each point in a group of similar sets, root the smallest point."""
    bits = least_agreement(percent)
    maps = _large_nodes(points, trees)
    placed = stage(_placed(points, trees, maps), "placed")
    small, crowd = placed.filter("not crowd").drop("crowd"), placed.filter("crowd").drop("crowd")
    crowded = not crowd.isEmpty()
    near = stage(_mates(_by_node(small), percent, bits, None), "near")
    pairs, needed = _paired(near), near.select("p")
    if crowded:
        pairs = pairs.unionByName(_paired(_mates(_in_runs(crowd), percent, bits, RUN))).distinct()
        needed = needed.unionByName(crowd.select("p"))
    pairs = stage(pairs, "pairs")
    sets = _needed_sets(texts, points, needed.distinct(), shingle)
    roots = components(_linked(pairs, sets, percent))

    if crowded:
        # one point per group and node, until the groups of a large node have found each other
        for _ in range(2):
            first = F.min_by(F.struct("p", "n", *_SKETCH), F.xxhash64("p")).alias("r")
            heads = _grouped(crowd, roots).groupBy("node", "root").agg(first).select("node", "root", "r.*")
            more = _paired(_mates(_in_runs(heads), percent, bits, RUN)).join(pairs, ["a", "b"], "left_anti")
            links = _linked(more, sets, percent)
            if links.isEmpty():
                break
            roots = _merged(roots, links)
        met = _crowd_pairs(_grouped(crowd, roots), sets, percent, bits)
        roots = _merged(roots, _linked(met, sets, percent))
        unstage(met)

    rest = _open_pairs(_by_node(_grouped(near.drop("mate"), roots)), percent, bits)
    rest = rest.join(pairs, ["a", "b"], "left_anti")
    roots = _merged(roots, _linked(rest, sets, percent))
    for done in (placed, near, pairs, sets):
        unstage(done)
    return roots


def similar_groups(
    docs: DataFrame, shingle: int = 5, percent: int = 80, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id of its group), kept (it is that id)."""
    texts = docs.select(F.col(id_col).cast("long").alias("k"), text_of(text_col).alias("text"))
    texts = texts.withColumn("th", F.xxhash64("text")).withColumn("k", F.coalesce("k", F.lit(2**63 - 1)))
    trees = trees_for(percent, recall)
    described = stage(_described(texts, shingle, trees), "described")
    same = described.filter("n > 0").groupBy("h1", "h2").agg(
        F.min(F.struct("k", "th")).alias("head"), *[F.first(c).alias(c) for c in ("n", "sketch", "chosen")])
    points = stage(same.select(F.monotonically_increasing_id().alias("p"), "h1", "h2", "head.k", "head.th", "n", "sketch", "chosen"), "points")
    roots = _roots(texts, points, shingle, percent, trees).withColumnRenamed("node", "p")
    named = points.select("p", "h1", "h2", "k").join(roots, "p", "left").withColumn("root", F.coalesce("root", "p"))
    heads = named.groupBy("root").agg(F.min("k").alias("head"))
    named = stage(named.join(heads, "root").select("h1", "h2", "head"), "named")
    unstage(points)
    found = described.select("k", "h1", "h2", "n").join(named, ["h1", "h2"], "left")
    missing = F.lit(2**63 - 1)
    found = found.withColumn("head", F.coalesce("head", "k"))
    return found.select(
        F.when(F.col("k") != missing, F.col("k")).alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("head") != missing, F.col("head")).alias("component_id"), (F.col("k") == F.col("head")).alias("kept"))

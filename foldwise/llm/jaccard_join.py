"""N-gram Jaccard self-join with prefix filters under several token orders.

A text is the set of its distinct five-word shingles. Two texts as similar as asked share a
token among the first ones of both, whatever the order of tokens, so a pair has to pass
this filter under three orders before its texts move: rare tokens first, a coarser
rarity with other ties, and a plain hash. Pairs are found under the first order, in buckets;
``intersected`` keeps those that the other two orders find as well, from short marks of the
first tokens that lie beside each set. Only what is left is verified.
Rarity comes from a fixed number of counters filled by the whole corpus.

Groups of copies never become all pairs. Equal sets within a task are linked at once. Then
every text is verified against one text of its buckets, the one it shares most with; the
links found give components. Last come the pairs of a bucket that still lie in different
components. They are held against each other within the task by parity sketches: two
sketches differ in no more bits than the sets differ in tokens, so pairs whose sketches are
too far apart are not alike and never leave the task; the others are verified. A pair left
out is refuted or already connected, so the components are exact. Large buckets are cut
into blocks, and every two blocks meet in a task of their own.

Nulls: a null text counts as empty; texts without words have an empty set and are linked
with nothing. A null id has no links and a null component. Rows that repeat an id are one
text for linking if equal, and otherwise share what either links to. Short texts are one
shingle. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.array_sums import summed
from foldwise.llm.graph import components
from foldwise.llm.shared import Scratch
from foldwise.llm.textbytes import Chunk, RangeHash, chunks, laid, mix, pick, sequence_hash

#: Orders besides the first, and the columns that hold their marks.
ORDERS = ("second", "third")
#: Counters of token rarity, and parts in which they are summed.
CELL_BITS, CELL_PARTS = 20, 64
#: Bits of the filter that keeps texts without a candidate from moving; speed only.
FILTER_BITS = 1 << 25
#: Bits of the largest parity sketch, and rows of a bucket that one task holds at once.
SKETCH_BITS, BLOCK_ROWS = 1 << 13, 2048
#: First tokens of a set up to which two bytes of each are kept; speed only.
FEW_MARKS = 256
#: Pairs verified at once.
CHECK_ROWS = 128
#: Sets a task remembers to spot equal ones; beyond it they meet in their buckets.
SEEN = 200_000


def shingles(chunk: Chunk, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, repeats included, and the number of its text (ascending)."""
    begin, end, text = chunk.words
    hashed = RangeHash(chunk.lowered).of(begin, end)
    grams = sequence_hash(hashed, words)
    inside = text[words - 1:] == text[:len(grams)] if len(grams) else np.zeros(0, bool)
    grams, owner = mix(grams[inside] + np.uint64(words)), text[:len(grams)][inside]
    held = chunk.per_text(text)
    short = np.flatnonzero((held > 0) & (held < words))
    if not len(short):
        return grams, owner
    first = np.searchsorted(text, short)
    whole = np.array([_whole(hashed[f:f + n]) for f, n in zip(first.tolist(),
                                                              held[short].tolist())], np.uint64)
    order = np.argsort(np.append(owner, short), kind="stable")
    return np.append(grams, whole)[order], np.append(owner, short)[order]


def _whole(hashed: np.ndarray) -> int:
    return int(mix(sequence_hash(hashed, len(hashed)) + np.uint64(len(hashed)))[0])


def sets(chunk: Chunk, words: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    grams, owner = shingles(chunk, words)
    cuts = np.searchsorted(owner, np.arange(len(chunk) + 1)).tolist()
    return [np.unique(grams[a:b]) for a, b in zip(cuts, cuts[1:])]


def rarity(source: DataFrame, text_col: str, words: int) -> np.ndarray:
    """Four times the binary logarithm of the shingles that fall on each counter."""
    cells = 1 << CELL_BITS

    def count(batches):
        total = np.zeros(cells, dtype=np.int64)
        for chunk in chunks(batches, text_col):
            grams, _ = shingles(chunk, words)
            total += np.bincount((grams & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
        return np.minimum(total, 2**32 - 1)

    total = summed(source.select(text_col), count, cells, CELL_PARTS, "<u4")
    return np.floor(4 * np.log2(total + 1)).astype(np.uint8)


def prefix(tokens: np.ndarray, rare: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens of a set under an order, in that order; similar sets share one."""
    n = len(tokens)
    size = n + (-percent * n // 100) + 1 if n else 0
    if order == 2:
        key = mix(tokens + np.uint64(77))
    else:
        level = rare[tokens & np.uint64(len(rare) - 1)].astype(np.uint64)
        spread = tokens if order == 0 else mix(tokens + np.uint64(order))
        level = level if order == 0 else level >> np.uint64(3)
        key = level << np.uint64(56) | spread >> np.uint64(8)
    some = np.argpartition(key, size - 1)[:size] if size < n else np.arange(n)
    return tokens[some[np.argsort(key[some])]]


def parity(tokens: np.ndarray) -> bytes:
    """One bit per cell: whether an odd number of tokens falls on it."""
    size = min(max(64, 1 << int(len(tokens)).bit_length()), SKETCH_BITS)
    at = (mix(tokens + np.uint64(3)) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=size) & 1).astype(np.uint8),
                       bitorder="little").tobytes()


def overlap(a, b, percent: int):
    """Tokens that sets of these sizes have to share."""
    return -(-percent * (a + b) // (100 + percent))


def near_pairs(group: np.ndarray, size: np.ndarray, place: np.ndarray, component: np.ndarray,
               block: np.ndarray, mixed: np.ndarray, sketches: list,
               percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that sizes, places, components and sketches allow.

    The first token two sets share stands so early in both that enough others can follow.

    Groups are runs of equal numbers. Where ``mixed``, two blocks meet and only rows of
    different ones are paired.
    """
    words = np.array([len(x) // 8 for x in sketches], dtype=np.int64)
    wide = int(words.max(initial=1))
    held = np.zeros((len(group), wide), dtype=np.uint64)
    for i, x in enumerate(sketches):
        held[i, :words[i]] = np.frombuffer(x, np.uint64)
    left, right = [], []
    last = np.searchsorted(group, group, side="right") - 1
    live, d = np.arange(len(group)), 0
    while True:
        d += 1
        live = live[live + d <= last[live]]
        if not len(live):
            break
        i, j = live, live + d
        small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
        most = np.minimum(size[i] - place[i], size[j] - place[j]) + 1
        fits = ((component[i] != component[j]) & (100 * small >= percent * large)
                & (most >= overlap(small, large, percent))
                & (~mixed[i] | (block[i] != block[j])))
        i, j = i[fits], j[fits]
        swap = words[i] > words[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        for w in np.unique(words[i]).tolist():
            own = words[i] == w
            a, b = i[own], j[own]
            other = held[b, :w].copy()
            for part in range(1, int(words[b].max()) // w):  # longer sketches fold onto shorter
                other ^= held[b, part * w:(part + 1) * w]
            off = np.bitwise_count(held[a, :w] ^ other).sum(axis=1, dtype=np.int64)
            good = (100 + percent) * off <= (100 - percent) * (size[a] + size[b])
            left.append(a[good])
            right.append(b[good])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([*left, none]), np.concatenate([*right, none])


def marks(tokens: np.ndarray) -> bytes:
    """Upper bits of tokens, two bytes each if few and four if many; the first byte says which."""
    kind = "<u2" if len(tokens) <= FEW_MARKS else "<u4"
    bits = np.dtype(kind).itemsize * 8
    return bytes([bits]) + np.unique(tokens >> np.uint64(64 - bits)).astype(kind).tobytes()


def meet_marks(a: bytes, b: bytes) -> bool:
    """Whether two lists of marks share one; lists of equal tokens always do."""
    one, two = (np.frombuffer(x[1:], f"<u{x[0] // 8}") for x in (a, b))
    if one.dtype != two.dtype:
        one, two = (x if x.itemsize == 2 else x >> 16 for x in (one, two))
    return bool(np.isin(one, two).any())


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets are as similar as asked."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large or not small:
        return False
    common = np.intersect1d(a, b, assume_unique=True)
    return 100 * len(common) >= percent * (len(a) + len(b) - len(common))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
         percent: int = 80) -> DataFrame:
    """Components of texts linked by a Jaccard similarity of ``percent`` or more.

    Returns ``id_col, n_shingles long, component_id long`` per row; ids must be whole
    numbers. The component is the smallest id within reach, the row's own included.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    source = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("id"),
                                                 F.col(text_col).alias("text"))
    rare = spark.sparkContext.broadcast(rarity(source, "text", words))  # one byte a counter

    def described(batches):
        for chunk in chunks(batches):
            each = sets(chunk, words)
            yield pa.RecordBatch.from_pydict({
                "id": chunk.rows.column(0),
                "n": pa.array([len(x) for x in each], pa.int64()),
                "sketch": pa.array([parity(x) for x in each], pa.binary()),
                **{name: pa.array([marks(prefix(x, rare.value, order, percent)) for x in each],
                                  pa.binary()) for order, name in enumerate(ORDERS, 1)}})

    def tokens(batches):
        seen: dict[bytes, int] = {}
        for chunk in chunks(batches):
            ids = chunk.rows.column(0).to_pylist()
            parts, owners, places, copy_of = [], [], [], []
            sizes = np.zeros(len(ids), dtype=np.int64)
            for i, (name, own) in enumerate(zip(ids, sets(chunk, words))):
                if name is None or not len(own):
                    continue
                # Two sums over 64-bit hashes and the size stand for the set.
                mark = np.array([own.sum(), mix(own).sum(), len(own)], np.uint64).tobytes()
                first = seen.setdefault(mark, name) if len(seen) < SEEN else seen.get(mark, name)
                # One row in a bucket of its own tells of a copy, so copies of one text spread.
                mine = (prefix(own, rare.value, 0, percent) if first == name
                        else mix(np.array([name], np.int64).view(np.uint64)))
                sizes[i] = len(own)
                parts.append(mine)
                owners.append(np.full(len(mine), i))
                places.append(np.arange(1, len(mine) + 1))
                copy_of.extend([first if first != name else None] * len(mine))
            if parts:
                owner = np.concatenate(owners)
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(np.concatenate(parts).view(np.int64)),
                    "id": chunk.rows.column(0).take(pa.array(owner)),
                    "n": pa.array(sizes[owner]),
                    "place": pa.array(np.concatenate(places)),
                    "copy_of": pa.array(copy_of, pa.int64())})

    # The first tokens, most of which no other text has, go straight into their buckets.
    nodes = scratch.write(source.mapInArrow(
        described, "id long, n long, sketch binary, second binary, third binary"), "shingle-sets")
    found = source.mapInArrow(tokens, "token long, id long, n long, place long, copy_of long")

    bucket = Window.partitionBy("token")
    # A row stays if its token can be the first one shared with the smallest set that its
    # size allows in the bucket.
    partner = F.greatest(F.min("n").over(bucket), F.expr(f"({percent} * n + 99) div 100"))
    need = F.expr(f"({percent} * (n + partner) + {99 + percent}) div {100 + percent}")
    shared = (found.withColumn("leader", F.min(F.struct("id", "n")).over(bucket))
              .withColumn("last", F.max("id").over(bucket)).withColumn("partner", partner)
              .where(F.col("copy_of").isNotNull()
                     | (F.col("leader.id") < F.col("last")) & (F.col("place") <= F.col("n") - need + 1))
              .select("token", "id", "n", "place", "copy_of", F.col("leader.id").alias("leader"),
                      F.col("leader.n").alias("leader_n")))
    shared = scratch.write(shared, "shingle-buckets")
    copies = shared.where("copy_of is not null").select(F.col("id").alias("a"),
                                                        F.col("copy_of").alias("b"))
    shared = shared.where("copy_of is null")
    scratch.drop((nodes, shared))

    # First every text against one other.
    best = (shared.where(F.col("id") != F.col("leader"))
            .where(close("n", "leader_n", percent))
            .groupBy("id", "leader").agg(F.count(F.lit(1)).alias("m"))
            .groupBy("id").agg(F.max_by("leader", F.struct("m", "leader")).alias("b"))
            .select(F.col("id").alias("a"), "b"))
    best = scratch.write(best, "shingle-candidates")
    both = scratch.write(intersected(nodes, best), "shingle-candidates")
    links = scratch.write(copies.union(verified(source, both, words, percent)),
                          "shingle-links")
    scratch.drop((nodes, shared, links))
    told = components(links)

    # Then what still lies apart within a bucket.
    placed = (shared.select("token", "id", "n", "place").join(told, "id", "left")
              .withColumn("component", F.coalesce("component", "id"))
              .withColumn("low", F.min("component").over(bucket))
              .withColumn("high", F.max("component").over(bucket))
              .withColumn("held", F.count(F.lit(1)).over(bucket))
              .where("low < high").drop("low", "high"))
    sketched = nodes.where("id is not null").select("id", "n", "sketch")
    placed = placed.join(sketched, ["id", "n"])
    ways = F.ceil(F.col("held") / BLOCK_ROWS)
    dealt = (placed.withColumn("ways", ways)
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("ways")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1)))
             .select("token", F.least("block", "other").alias("one"),
                     F.greatest("block", "other").alias("two"), "block", "id", "n", "place",
                     "component", "sketch"))
    key = ["token", "one", "two"]

    def meet(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            keys = np.stack([rows[k].to_numpy() for k in key])
            change = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))
            begin = int(np.flatnonzero(change)[-1])  # the last group may go on
            held = rows.slice(begin)
            yield from paired(rows.slice(0, begin), np.cumsum(change)[:begin])
        if held is not None:
            yield from paired(held, np.zeros(len(held), dtype=np.int64))

    def paired(rows: pa.Table, group: np.ndarray):
        if not len(rows):
            return
        ids = rows["id"].to_numpy()
        a, b = near_pairs(group, rows["n"].to_numpy(), rows["place"].to_numpy(),
                          rows["component"].to_numpy(), rows["block"].to_numpy(),
                          rows["one"].to_numpy() != rows["two"].to_numpy(),
                          rows["sketch"].to_pylist(), percent)
        a, b = ids[a], ids[b]
        yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)),
                                          "b": pa.array(np.maximum(a, b))})

    apart = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        meet, "a long, b long").distinct()
    apart = scratch.write(apart, "shingle-pairs")
    both = scratch.write(intersected(nodes, apart), "shingle-pairs")
    told = components(links.union(verified(source, both, words, percent)))
    scratch.drop((nodes, told))
    return nodes.select("id", "n").join(told, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"))


def close(a: str, b: str, percent: int):
    """Sizes that allow the similarity."""
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def intersected(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` found under the first order that every other order finds too.

    Marks are parts of tokens, so a pair that shares a token under an order stays.
    """

    def held(side: str) -> DataFrame:
        only = _among(pairs, side)
        names = [f"{x}_{side}" for x in ORDERS]

        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays(only(batch).columns[:-1], names=[side, *names])

        return nodes.where("id is not null").select("id", *ORDERS).withColumn(
            "at", _place("id")).mapInArrow(
            run, ", ".join([f"{side} long", *(f"{x} binary" for x in names)]))

    def check(batches):
        for batch in batches:
            good = np.ones(batch.num_rows, dtype=bool)
            for name in ORDERS:
                for i in np.flatnonzero(good).tolist():
                    good[i] = meet_marks(batch[f"{name}_a"][i].as_py(),
                                         batch[f"{name}_b"][i].as_py())
            yield batch.select(["a", "b"]).filter(pa.array(good))

    rows = pairs.hint("merge").join(held("a"), "a").hint("merge").join(held("b"), "b")
    return rows.mapInArrow(check, "a long, b long").distinct()


def verified(source: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are as similar as asked.

    Compressed texts travel to the pairs, being smaller than their sets.
    """

    def held(side: str) -> DataFrame:
        only = _among(pairs, side)

        def run(batches):
            for batch in batches:
                for chunk in chunks([only(batch)]):
                    raw, pack = chunk.data.tobytes(), zstandard.ZstdCompressor(3).compress
                    held = [pack(raw[x:y]) for x, y in zip(chunk.starts.tolist(),
                                                           chunk.ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [chunk.rows.column(0), pa.array(held, pa.binary())],
                        names=[side, f"text_{side}"])

        return source.where("id is not null").withColumn("at", _place("id")).mapInArrow(
            run, f"{side} long, text_{side} binary")

    def opened(blobs: pa.Array) -> list[np.ndarray]:
        """Shingles of compressed texts, equal ones opened once."""
        coded = blobs.dictionary_encode()
        texts = [zstandard.decompress(x) for x in coded.dictionary.to_pylist()]
        batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.large_binary())})
        each = [x for chunk in chunks([batch]) for x in sets(chunk, words)]
        return [each[i] for i in coded.indices.to_pylist()]

    def check(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHECK_ROWS):
                some = batch.slice(at, CHECK_ROWS)
                good = [alike(x, y, percent)
                        for x, y in zip(opened(some.column(2)), opened(some.column(3)))]
                yield some.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # Pairs grow with the corpus, so both joins sort and merge at every size.
    rows = pairs.hint("merge").join(held("a"), "a").hint("merge").join(held("b"), "b")
    return rows.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def _among(pairs: DataFrame, side: str):
    """A filter of batches whose last column is the place of an id: ids without a pair go."""
    wanted = _bits(pairs.select(F.col(side).alias("id")))
    own = pairs.sparkSession.sparkContext.broadcast(wanted)  # FILTER_BITS bits

    def only(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.column(batch.num_columns - 1).to_numpy()
        mask = own.value[at >> 3] >> (at & 7).astype(np.uint8) & 1
        return batch.filter(pa.array(mask.astype(bool)))

    return only


def _place(name: str):
    return F.pmod(F.xxhash64(name), F.lit(FILTER_BITS))


def _bits(ids: DataFrame) -> np.ndarray:
    """A filter of fixed size with the places of all ids set."""
    place = ids.select(_place("id").alias("at"))
    rows = place.groupBy(F.expr("at div 32768").alias("part")).agg(
        F.expr("bitmap_construct_agg(at % 32768)").alias("bits")).toArrow().to_pylist()
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in rows:
        out[row["part"] * 4096:(row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
              percent: int = 80) -> DataFrame:
    """The given rows without all but the smallest id of each component.

    All columns stay. Of equal rows that repeat an id one stays; null ids all stay.
    """
    plain, at = laid(docs, id_col, text_col)
    id_col, text_col = at[id_col], at[text_col]
    linked = link(plain, id_col, text_col, words, percent)
    gone = linked.where(F.col("component_id") < F.col(id_col)).select(id_col).distinct()
    same = Window.partitionBy(id_col, F.xxhash64(text_col)).orderBy(F.lit(1))
    named = plain.where(F.col(id_col).isNotNull()).join(gone, id_col, "left_anti")
    once = named.withColumn("__copy", F.row_number().over(same)).where("__copy = 1")
    return (once.select(*plain.columns).union(plain.where(F.col(id_col).isNull()))
            .toDF(*docs.columns))

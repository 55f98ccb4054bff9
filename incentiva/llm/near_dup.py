"""Near-duplicate documents: ProbMinHash signatures, banding, exact verification, components.

Likeness is the probability Jaccard similarity of weighted shingles (five words, weight:
number of occurrences): J(A, B) = sum over d of 1 / sum over d' of max(A[d'] / A[d],
B[d'] / B[d]); with equal weights it is the plain Jaccard similarity.

1. Signature, one pass over whole texts. Each shingle is a Poisson process whose rate is
   its weight; each arrival falls into one of ``registers`` at random, a register keeps
   the shingle that arrives first. Arrivals are drawn in order and a document stops as
   soon as all its registers hold an earlier one, so the work follows the number of
   shingles, not shingles x registers.
2. Texts with the same words are one node, so a group of copies, however large, is one
   node from here on (a 64-bit hash of the words names it).
3. Banding: ``bands`` keys of ``rows`` registers. At similarity 0.8 two nodes share no key
   with probability (1 - 0.8**5)**32 = 3e-6. No key is capped.
4. Within a key nodes are compared with a pivot (another one each round) and linked if the
   exact similarity reaches ``threshold``; nodes already in one component need no further
   comparison, so a group of k near copies costs about k comparisons, not k squared. What
   then is left of a key, pairs across components, goes block by block of that key through a sieve of
   longer signatures, and what passes is compared exactly. No candidate pair is capped;
   the sieve drops a pair at the threshold with probability 3e-7 (five deviations).
5. A document's class is the least doc_id of its component.

Defined cases: documents with null or empty text are a class of their own; texts with
no word are equal only if equal as strings; fewer than five words are one shingle;
repeated rows are copies of each other; a null doc_id takes part, but a class is named
by its least non-null id (null if there is none). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, lookup, small, text_slices, utf8_parts
from .components import connected_components
from .words import mix, shingles, split_words, uniform

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
PIVOT_ROUNDS = 3
_U = np.uint64
_ID_BITS = 44
_ID_MASK = _U((1 << _ID_BITS) - 1)
_ROWS_AT_ONCE = 1 << (64 - _ID_BITS - 1)


def weighted_shingles(texts: pa.Array, size: int = SHINGLE):
    """(row, id, weight) of the distinct shingles of each row, sorted; node hash and kind of each row."""
    raw, at = utf8_parts(texts)
    w = split_words(raw, at)
    row, h = shingles(w, size)
    key = np.sort((row.astype(_U) << _U(_ID_BITS)) | (h & _ID_MASK))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    weight = np.diff(np.append(first, len(key))).astype(np.float64)
    key = key[first]
    return (key >> _U(_ID_BITS)).astype(np.int64), key & _ID_MASK, weight, _nodes(raw, at, w)


_P = 0xD6E8FEB86659FD93


def _sequence_hash(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of each run h[at[i]:at[i+1]]."""
    n = len(h)
    up = np.cumprod(np.where(np.arange(n + 1) == 0, _U(1), _U(_P)), dtype=_U)
    down = np.cumprod(np.where(np.arange(n + 1) == 0, _U(1), _U(pow(_P, -1, 1 << 64))), dtype=_U)
    total = np.zeros(n + 1, _U)
    np.cumsum(h * up[:n], dtype=_U, out=total[1:])
    return mix((total[at[1:]] - total[at[:-1]]) * down[at[:-1]] + np.diff(at).astype(_U))


def _nodes(raw: np.ndarray, at: np.ndarray, w) -> np.ndarray:
    """Hash of each row's words; of its bytes if it has no word; 0 for empty."""
    first = np.zeros(len(at), np.int64)
    np.cumsum(w.count, out=first[1:])
    node = _sequence_hash(w.hash, first)
    bare = np.flatnonzero(w.count == 0)
    for i in bare:
        part = raw[at[i]: at[i + 1]]
        node[i] = _sequence_hash(mix(part.astype(_U)), np.array([0, len(part)]))[0] ^ _U(0x5851F42D4C957F2D) if len(part) else 0
    return node


def prob_minhash(row: np.ndarray, ids: np.ndarray, weight: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """The shingle of each register, (n_rows, registers); rows without shingles keep 0.

    Arrival j of shingle d: time += Exp(1) / weight, register chosen at random, both
    from a hash of (d, j), so equal shingles draw equal arrivals in every document.
    """
    best = np.full(n_rows * registers, np.inf)
    winner = np.zeros(n_rows * registers, _U)
    total = np.bincount(row, weight, n_rows)
    # arrivals drawn per shingle and round: together about two per register and document
    block = np.maximum(1, np.ceil(2 * registers * weight / total[row])).astype(np.int64) if len(row) else np.zeros(0, np.int64)
    alive = np.arange(len(row))
    time = np.zeros(len(row))
    drawn = np.zeros(len(row), np.int64)
    while len(alive):
        n = block[alive]
        at = np.repeat(np.arange(len(alive)), n)
        head = np.cumsum(n) - n
        j = drawn[alive][at] + np.arange(len(at)) - head[at]
        who = alive[at]
        bits = mix(ids[who] * _U(0x9E3779B97F4A7C15) + mix(j.astype(_U)))
        step = -np.log(uniform(bits)) / weight[who]
        total_steps = np.cumsum(step)
        h = time[who] + total_steps - (total_steps[head] - step[head])[at]
        slot = row[who] * registers + (mix(bits) % _U(registers)).astype(np.int64)
        np.minimum.at(best, slot, h)
        won = h == best[slot]
        winner[slot[won]] = ids[who[won]]
        last = head + n - 1
        time[alive], drawn[alive] = h[last], drawn[alive] + n
        worst = best.reshape(n_rows, registers).max(axis=1)
        alive = alive[time[alive] < worst[row[alive]]]
    return winner.reshape(n_rows, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), _U)
    for k in range(rows):
        keys = mix(keys + signature[:, k::rows][:, :bands])
    return mix(keys + np.arange(1, bands + 1, dtype=_U))


def _sign(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in text_slices(whole, "text"):
            row, ids, weight, node = weighted_shingles(b.column("text"), size)
            keys = band_keys(prob_minhash(row, ids, weight, b.num_rows, bands * rows), bands, rows).view(np.int64)
            has = np.bincount(row, minlength=b.num_rows) > 0
            offsets = np.zeros(b.num_rows + 1, np.int32)
            np.cumsum(has * bands, out=offsets[1:])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[has].ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("h"), pa.array(node.view(np.int64), mask=node == 0), lists], ["id", "h", "node", "keys"])


def probability_jaccard(a_ids, a_w, b_ids, b_w) -> float:
    """Exact similarity of two weighted sets, ids sorted. In O(n log n): shingles sorted by the ratio of their weights."""
    ids = np.union1d(a_ids, b_ids)
    a, b = np.zeros(len(ids)), np.zeros(len(ids))
    a[np.searchsorted(ids, a_ids)] = a_w
    b[np.searchsorted(ids, b_ids)] = b_w
    if np.array_equal(a, b):
        return 1.0
    with np.errstate(divide="ignore"):
        ratio = a / b
    order = np.argsort(ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    # max(a'/a, b'/b) is a'/a where the ratio a'/b' is at least a/b, else b'/b
    from_a = np.cumsum(a[::-1])[::-1]
    before_b = np.cumsum(b) - b
    both = (a > 0) & (b > 0)
    at = np.searchsorted(ratio, ratio[both])  # the first of equal ratios
    return float(np.sum(1.0 / (from_a[at] / a[both] + before_b[at] / b[both])))


def _verify(batches: Iterator[pa.RecordBatch], size: int, threshold: float) -> Iterator[pa.RecordBatch]:
    known: dict[int, tuple] = {}

    def sets(node: int, text: pa.Scalar) -> tuple:
        if node not in known:
            if len(known) >= 64:
                known.clear()
            _, ids, weight, _ = weighted_shingles(pa.array([text], pa.large_string()), size)
            known[node] = ids, weight
        return known[node]

    for b in batches:
        u, v = b.column("u").to_numpy(), b.column("v").to_numpy()
        tu, tv = b.column("tu"), b.column("tv")
        yes = [probability_jaccard(*sets(x, tu[i].as_py()), *sets(y, tv[i].as_py())) >= threshold
               for i, (x, y) in enumerate(zip(u.tolist(), v.tolist()))]
        keep = np.array(yes, bool)
        yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], ["u", "v"])


def _texts(docs: DataFrame, nodes: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(node, text) of the wanted nodes. ``nodes``: node, h (the hash of one of its texts)."""
    found = docs.select(F.xxhash64("text").alias("h"), "text").join(small(nodes), "h")
    return stage.put(found.groupBy("node").agg(F.first("text").alias("text")), name)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """One row per document: id_col, class_id (least id of its class), class_size."""
    return _classes(docs, Stage(docs.sparkSession, "near-dup"), id_col, text_col, size, threshold, bands, rows, pivot_rounds).select(
        F.col("id").alias(id_col), "class_id", "class_size")


def _classes(docs: DataFrame, stage: Stage, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
             threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """One row per document: id, h (hash of its text), class_id, class_size, first: (unnamed, id, h) of the one that stands for its class."""
    kind = docs.schema[id_col].dataType
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = stage.put(docs.select("id", F.xxhash64("text").alias("h"), "text").mapInArrow(
        lambda batches: _sign(batches, size, bands, rows),
        f"id {kind.simpleString()}, h bigint, node bigint, keys array<bigint>"), "signed")

    labels = link_nodes(docs, signed, stage, size, threshold, pivot_rounds, bands, rows)
    member = signed.select("id", "h", "node").join(small(labels), "node", "left").withColumn("class", F.coalesce("label", "node"))
    classes = stage.put(member.where("class is not null").groupBy("class").agg(
        F.min("id").alias("class_id"), F.count("*").alias("class_size"),
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "h")).alias("first")).where("class_size > 1"), "classes")
    return member.join(small(classes), "class", "left").select(
        "id", "h", "first",
        F.when(F.col("class_size").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def link_nodes(docs: DataFrame, signed: DataFrame, stage: Stage, size: int, threshold: float, pivot_rounds: int,
               bands: int, rows: int) -> DataFrame:
    """(node, label) for nodes linked to others: the least node of the component that all candidate pairs at or above the threshold make."""
    band = signed.select("node", F.explode("keys").alias("key"))
    shared = stage.put(band.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
                       .where("lo < hi").select("key"), "shared-keys")
    members = stage.put(band.join(small(shared, 500_000), "key").distinct(), "members-0")
    # the hash of one text of each node, to fetch it
    wanted = stage.put(members.select("node").distinct(), "wanted")
    names = stage.put(signed.join(small(wanted), "node", "left_semi").groupBy("node").agg(F.min("h").alias("h")), "names")
    texts = _texts(docs, names, stage, "texts")

    tested = labels = None
    for k in range(pivot_rounds):
        order = F.xxhash64("node", F.lit(k))
        first = [F.min_by("node", order).alias("pivot")] + ([F.min_by("label", order).alias("pivot_label")] if k else [])
        pivots = stage.put(members.groupBy("key").agg(*first), f"pivots-{k}")
        pairs = members.join(small(pivots, 500_000), "key").where("label <> pivot_label" if k else "node <> pivot") \
            .select(F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v")).distinct()
        pairs = stage.put(pairs.join(tested, ["u", "v"], "left_anti") if k else pairs, f"pairs-{k}")
        links = _verified(pairs, texts, stage, f"links-{k}", size, threshold)
        labels = _merged(labels, links, stage, f"labels-{k}")
        tested = tested.union(pairs) if k else pairs
        members = members.select("key", "node").join(small(labels), "node", "left") \
            .select("key", "node", F.coalesce("label", "node").alias("label"))
        open_keys = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
        members = stage.put(members.join(small(stage.put(open_keys, f"open-{k}"), 500_000), "key", "left_semi"), f"members-{k + 1}")
    rest = _rest(members, tested, texts, stage, size, threshold, bands, rows)
    return _merged(labels, _verified(rest, texts, stage, "links-rest", size, threshold), stage, "labels")


def _merged(labels: DataFrame | None, links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """Labels after new links: only the links between unlike labels are looked at."""
    if labels is None:
        return stage.put(connected_components(links, stage, f"{name}-new"), name)
    known = small(labels)
    u = links.join(known.toDF("u", "lu"), "u", "left").select("v", F.coalesce("lu", "u").alias("u"))
    edges = u.join(known.toDF("v", "lv"), "v", "left").select("u", F.coalesce("lv", "v").alias("v"))
    new = small(stage.put(connected_components(edges, stage, f"{name}-new"), f"{name}-map"))
    moved = labels.join(new.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return stage.put(moved.union(new.join(labels.select("node"), "node", "left_anti")), name)


def _verified(pairs: DataFrame, texts: DataFrame, stage: Stage, name: str, size: int, threshold: float) -> DataFrame:
    both = pairs.join(texts.toDF("u", "tu"), "u").join(texts.toDF("v", "tv"), "v")
    return stage.put(both.mapInArrow(lambda batches: _verify(batches, size, threshold), "u bigint, v bigint"), name)


#: Registers (a byte each) of the longer signature that sieves the pairs which pivots left open.
SIEVE = 1024
#: Nodes of a block: a task compares two blocks of a key, of about 1.3 KB a node.
BLOCK = 512
#: Keys of at most so many nodes share tasks.
PACKED = 128
_TILE = 128


def _rest(members: DataFrame, tested: DataFrame, texts: DataFrame, stage: Stage, size: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """Pairs that share a key but not a component, sieved by a longer signature.

    Only nodes with a common key are compared, so the work is the sum over the open keys of their members squared. The
    nodes of a key are dealt by hash into blocks of about BLOCK, and each pair of blocks is one task; keys of
    a handful of nodes are packed into tasks by hash. A task compares signatures in memory, takes a pair only in the
    first of the keys that it shares (that one is open too, as its labels differ), and emits only pairs whose
    estimate is within five standard deviations of the threshold.
    """
    sizes = stage.put(members.groupBy("key").agg(F.count("*").alias("n")), "open-sizes")
    packed = sizes.where(F.col("n") <= PACKED).agg(F.sum("n")).first()[0] or 0
    tasks = lookup(members, sizes, ["key"], stage, "open-sizes", n_col="n").withColumn("few", F.col("n") <= PACKED) \
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pack = F.pmod(F.xxhash64("key"), F.lit(max(1, packed // BLOCK)))
    tasks = tasks.select(F.when(F.col("few"), pack).otherwise(F.col("key")).alias("task"), "few", F.least("block", "other").alias("i"),
                         F.greatest("block", "other").alias("j"), "block", "key", "node", "label")
    nodes = stage.put(members.select("node").distinct(), "open")
    long = stage.put(texts.join(small(nodes), "node").mapInArrow(
        lambda batches: _long_signatures(batches, size, bands, rows), "node bigint, keys binary, sieve binary"), "long")
    found = tasks.join(long, "node").groupBy("task", "few", "i", "j").applyInArrow(lambda t: _sieve(t, threshold), "u bigint, v bigint")
    return stage.put(found.join(tested, ["u", "v"], "left_anti"), "pairs-rest")


def _long_signatures(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in text_slices(whole, "text", 250_000):
            row, ids, weight, _ = weighted_shingles(b.column("text"), size)
            keys = band_keys(prob_minhash(row, ids, weight, b.num_rows, bands * rows), bands, rows)
            sieve = (mix(prob_minhash(row, ids, weight, b.num_rows, SIEVE)) & _U(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([x.tobytes() for x in keys], pa.binary()), pa.array([x.tobytes() for x in sieve], pa.binary())],
                ["node", "keys", "sieve"])


def _sieve(t: pa.Table, threshold: float) -> pa.Table:
    """Of the nodes of two blocks of a key (or of one, or of several small keys): pairs of unlike labels with a high estimate."""
    key, node, label, block = (t.column(c).to_numpy() for c in ("key", "node", "label", "block"))
    keys = np.frombuffer(b"".join(t.column("keys").to_pylist()), np.int64).reshape(len(node), -1)
    sieve = np.frombuffer(b"".join(t.column("sieve").to_pylist()), np.uint8).reshape(len(node), SIEVE)
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    # two bytes agree by chance once in 256
    least = threshold - 5 * (threshold * (1 - threshold) / SIEVE) ** 0.5
    least = SIEVE * (least + (1 - least) / 256)
    order = np.argsort(key, kind="stable")
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        left, right = part[block[part] == i], part[block[part] == j]
        for s in range(0, len(left), _TILE):
            a = left[s: s + _TILE]
            for e in range(s if i == j else 0, len(right), _TILE):
                b = right[e: e + _TILE]
                x, y = np.nonzero(label[a][:, None] != label[b][None, :])
                x, y = a[x], b[y]
                common = keys[x] == keys[y]
                mine = keys[x, common.argmax(axis=1)] == key[x] if len(x) else np.zeros(0, bool)
                x, y = x[mine], y[mine]
                near = np.count_nonzero(sieve[x] == sieve[y], axis=1) >= least if len(x) else np.zeros(0, bool)
                u.append(np.minimum(node[x[near]], node[y[near]]))
                v.append(np.maximum(node[x[near]], node[y[near]]))
    pairs = np.unique(np.stack([np.concatenate(u), np.concatenate(v)]), axis=1)
    return pa.table({"u": pairs[0], "v": pairs[1]})


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with one document of each class, a document being an id with a text: the least one (rows without an id last).

    So of rows with one id and unlike texts each stands for itself; of rows equal in id and text one stays.
    """
    names = docs.columns
    df = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text_col)}").cast("string")
    stage = Stage(docs.sparkSession, "near-dup-drop")
    classes = stage.put(_classes(docs, stage, id_col, text_col, **params).where("class_size > 1"), "grouped")
    this = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h"))
    gone = stage.put(classes.where(~this).select("id", "h").distinct(), "gone")
    same = key.eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("h"))
    kept = df.join(small(gone), same, "left_anti")
    # rows repeated as they are: one of each stays
    twice = stage.put(classes.where(this).groupBy("id", "h").count().where("count > 1").select("id", "h"), "twice")
    if not twice.isEmpty():
        marked = kept.join(small(twice), same, "left").withColumn("n", F.xxhash64(text))
        once, several = marked.where("h is null").drop("id", "h", "n"), marked.where("h is not null")
        kept = once.union(several.dropDuplicates(["id", "n"]).drop("id", "h", "n").select(df.columns))
    return kept.toDF(*names)

"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its sequence of lower-cased words and one end. A word is coded by
binary decisions: frequent words and the end by their path in one Huffman
tree, any other word by an escape and the paths of its bytes in a second tree.
Each decision is predicted in ``CONTEXTS`` ways from the training rows: how
often the branch was taken in that context, kept in hashed tables. The
predictions are mixed in the logistic domain with weights chosen by a gate
(kind of decision and how much each context has been seen). The weights are
learned on all training rows, with each decision's own count left out: one pass
counts decisions by gate, quantised predictions and branch in Spark, a table of
fixed size, and Newton steps on that table go on until they settle. They are then
refined online, decision by decision, through the whole of every text that is
scored. The score is the log10 probability of the whole text, in bits per byte
besides. Rows are adapted side by side (very long ones alone), in 64-bit floats and in an
order of operations that the row alone decides, so equal texts have equal scores.

Word counts of all training rows are summed in Spark and stay a table: counts
of the most frequent words travel to the tasks (``TOP_WORDS``, a fixed bound),
all others are looked up by a join. The predictors' tables have a fixed size
(``TABLE_BITS``); every training decision counts in them, and each task sends
what it has seen, so what is gathered grows with the corpus.

Defined cases: a null or empty text is the end alone; a null id is a row like
any other; repeated rows are scored each; without training rows every count is
0 and every decision even. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightlake.llm.text import IS_SPACE, Chunk, chunks, mix64
from brightlake.session import scratch_path

CONTEXTS = 3
TABLE_BITS = 22
BLOCK_BITS = 14
TOP_WORDS = 1 << 18
#: The most frequent of them have a path of their own.
CODED_WORDS = 1 << 16
#: The most frequent of those serve as a context for what follows.
MARKER_WORDS = 512
#: Decisions of a path whose counters lie side by side.
NEAR = 4
#: Levels of a stretched prediction in the table that the weights are fitted on, their width, and
#: the change of a weight that ends the steps.
LEVELS, WIDTH = 25, 0.75
SETTLED = 1e-6
RATE = 0.015
#: Decisions of a row that goes alone.
ALONE = 60_000
#: Text that a task turns into decisions at a time, in bytes.
CHUNK_BYTES = 1 << 19
SCORE_BYTES = 1 << 20
GATES = 2 * 4 * 4
_NODE_SEED = 11
_C = np.uint64(0x9E3779B97F4A7C15)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Paths of all symbols: first place, length, and the nodes and branches in a row."""
    n = len(counts)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, branch, new = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int8), n
    while len(heap) > 1:
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        parent[i], parent[j], branch[j] = new, new, 1
        heapq.heappush(heap, (a + b, new))
        new += 1
    top, at = new - 1, np.arange(n)
    nodes, turns, owner = [], [], []
    live = np.flatnonzero(at != top)
    while len(live):
        here = at[live]
        nodes.append(parent[here] - n)
        turns.append(branch[here])
        owner.append(live)
        at[live] = parent[here]
        live = live[at[live] != top]
    if not nodes:
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8)
    nodes, turns, owner = (np.concatenate(x[::-1]) for x in (nodes, turns, owner))
    order = np.argsort(owner, kind="stable")
    length = np.bincount(owner, minlength=n)
    return np.cumsum(length) - length, length, nodes[order], turns[order]


class Coder:
    """Turns texts into decisions. Symbols of words: 0 the end, 1 the escape, then words."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, ends: int, byte_counts: np.ndarray):
        order = np.lexsort((words, -counts))[:CODED_WORDS]
        rest = int(byte_counts[256]) - int(counts[order].sum())
        by_rank = words[order]
        self.sorted = np.argsort(by_rank)
        self.words = by_rank[self.sorted]
        first, length, node, turn = huffman(np.concatenate([[ends + 1, rest + 1], counts[order]]))
        first_b, length_b, node_b, turn_b = huffman(byte_counts + 1)
        self.bytes_at = len(first)
        self.first = np.concatenate([first, first_b + len(node)])
        self.length = np.concatenate([length, length_b])
        self.node = np.concatenate([node, node_b + len(first)])
        self.turn = np.concatenate([turn, turn_b]).astype(np.int8)
        rng = np.random.default_rng(_NODE_SEED)
        codes = rng.integers(0, 1 << 32, len(first) + 257, dtype=np.uint64).astype(np.uint32)
        # A subtree of NEAR levels has one hash and 2 ** NEAR places next to each other.
        step = np.arange(len(self.node))
        depth = step - np.repeat(self.first, self.length) if len(step) else step
        top, local = step - depth % NEAR, np.ones(len(step), np.uint32)
        for k in range(NEAR - 1):
            deeper = depth % NEAR > k
            local[deeper] = local[deeper] * 2 + self.turn[top[deeper] + k].astype(np.uint32)
        side = np.uint32((1 << NEAR) - 1)
        self.code = (codes[self.node[top]] & np.uint32((1 << TABLE_BITS) - 1) & ~side) | local

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.sorted[at] + 2, 1)

    def decisions(self, chunk: Chunk):
        """Slots of each decision in each context, its branch, its kind, and the rows' bounds."""
        starts, ends, rows = chunk.words()
        hashes = chunk.word_hashes()
        n, counts = chunk.n, chunk.word_counts()
        # Tokens: the words of each row, then its end.
        at = np.arange(len(rows)) + rows
        end_at = np.cumsum(counts + 1) - 1
        total = len(rows) + n
        symbol = np.zeros(total, np.int64)
        symbol[at] = self.symbols(hashes)
        word_hash, begin, width = (np.zeros(total, t) for t in (np.uint64, np.int64, np.int64))
        word_hash[at], begin[at], width[at] = hashes, starts, ends - starts
        row = np.repeat(np.arange(n), counts + 1)
        row_first = (end_at - counts)[row]
        here = np.arange(total)
        before = np.where(here > row_first, np.concatenate([[np.uint64(0)], word_hash[:-1]]),
                          np.uint64(1))
        marked = np.where((symbol >= 2) & (symbol < 2 + MARKER_WORDS), here, -1)
        marked = np.maximum.accumulate(np.concatenate([[-1], marked[:-1]])) if total else marked
        marker = np.where(marked >= row_first, symbol[marked], 0).astype(np.uint64)
        # Symbols: one for each token; after an escape the word's bytes and a stop.
        spelt = (symbol == 1)
        each = 1 + spelt * (width + 1)
        token = np.repeat(here, each)
        inside = np.arange(len(token)) - np.repeat(np.cumsum(each) - each, each)
        is_byte = inside > 0
        place = begin[token] + inside - 1
        value = np.zeros(len(token), np.int64)
        stop = is_byte & (inside > width[token])
        letters = is_byte & ~stop
        value[letters] = chunk.data[place[letters]]
        value[stop] = 256
        path = np.where(is_byte, self.bytes_at + value, symbol[token])
        zero = np.zeros(len(token), np.uint64)
        c0, c1, c2 = zero, before[token].copy(), marker[token] * _C + np.uint64(5)
        if is_byte.any():
            p, w = place[is_byte], begin[token[is_byte]]
            recent = [chunk.span_hash(np.maximum(p - k, w), p) + np.minimum(p - w, k).astype(np.uint64)
                      for k in (2, 3, 5)]
            c0 = zero.copy()
            c0[is_byte], c1[is_byte] = recent[0], recent[2]
            c2[is_byte] = c2[is_byte] * _C + recent[1]
        length = self.length[path]
        begin_at = np.cumsum(length) - length
        total = int(length.sum())
        step = np.arange(total) + np.repeat(self.first[path] - begin_at, length)
        code, turn = self.code[step], self.turn[step]
        mask = np.uint64((1 << TABLE_BITS) - 1)
        slots = [np.repeat((mix64(c + np.uint64(k + 1)) & mask).astype(np.uint32), length) ^ code
                 for k, c in enumerate((c0, c1, c2))]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(row[token], weights=length,
                                                            minlength=n).astype(np.int64))])
        return slots, turn, np.repeat(is_byte, length), bounds


# A table entry packs both branch counts, each as 8 * log2(1 + count) in a byte.

def pack(taken0: np.ndarray, taken1: np.ndarray) -> np.ndarray:
    level = [np.rint(8 * np.log2(1.0 + x)).astype(np.uint16) for x in (taken0, taken1)]
    return level[0] << np.uint16(8) | level[1]


def _lookups() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a packed entry: stretched probability, how much was seen, and the former with
    one count of the branch taken left out (for branch 0 and 1)."""
    count = 2.0 ** (np.arange(256) / 8) - 1
    zero, one = np.repeat(count, 256), np.tile(count, 256)
    less = lambda x: np.maximum(x - 1, 0)
    stretch = lambda a, b: np.log((b + 0.4) / (a + 0.4)).astype(np.float32)
    seen = np.digitize(zero + one, [0.5, 4, 40]).astype(np.uint8)
    return (stretch(zero, one), seen,
            np.concatenate([stretch(less(zero), one), stretch(zero, less(one))]))


STRETCH, SEEN, STRETCH_LESS = _lookups()


def predictions(tables: list[np.ndarray], slots: list[np.ndarray], turn: np.ndarray,
                is_byte: np.ndarray, leave_out: bool):
    """Stretched probabilities (contexts, decisions) and the gate of each decision."""
    entries = [t[s] for t, s in zip(tables, slots)]
    if leave_out:
        at = turn.astype(np.int64) << 16
        stretched = np.stack([STRETCH_LESS[e + at] for e in entries])
    else:
        stretched = np.stack([STRETCH[e] for e in entries])
    gate = (is_byte.astype(np.int32) * 16 + SEEN[entries[1]] * np.int32(4) + SEEN[entries[2]])
    return stretched, gate


def mix_scores(stretched, gate, turn, bounds, weights: np.ndarray) -> np.ndarray:
    """Natural-log probability of each row, its weights adapting after every decision.

    All rows that go on take their next decision together; the longest row has the first place.
    A row of over ``ALONE`` decisions has few beside it and goes alone, whatever stands there.
    """
    n, size = len(bounds) - 1, np.diff(bounds)
    out = np.zeros(n)
    alone = np.flatnonzero(size > ALONE)
    for i in alone:
        own = slice(bounds[i], bounds[i + 1])
        out[i] = _adapt([s[own] for s in stretched], gate[own], turn[own], weights)
    size[alone] = 0
    order = np.argsort(-size, kind="stable")
    start, size = bounds[:-1][order], size[order]
    steps = int(size[0]) if n else 0
    live = np.searchsorted(-size, -np.arange(steps), side="left")
    ends = np.cumsum(live)
    lane = np.arange(ends[-1] if steps else 0) - np.repeat(ends - live, live)
    source = start[lane] + np.repeat(np.arange(steps), live)
    sign = (2.0 * turn - 1)[source]
    inputs = [s[source] * sign for s in stretched]
    which = gate[source] + lane * GATES
    del source, sign
    own = [np.tile(w, n) for w in weights.T]
    margin = np.empty(len(lane))
    begin = 0
    with np.errstate(over="ignore"):
        for end in ends.tolist():
            at, here = which[begin:end], margin[begin:end]
            x = [i[begin:end] for i in inputs]
            w = [o.take(at) for o in own]
            np.multiply(w[0], x[0], out=here)
            for k in range(1, CONTEXTS):
                here += w[k] * x[k]
            pull = np.exp(here)
            pull += 1
            np.divide(RATE, pull, out=pull)
            for k in range(CONTEXTS):
                w[k] += x[k] * pull
                own[k][at] = w[k]
            begin = end
    np.clip(margin, -80, 80, out=margin)
    cost = np.log1p(np.exp(-np.abs(margin))) - np.minimum(margin, 0)
    if n:
        out[order] -= np.bincount(lane, cost, n)
    return out


def _adapt(stretched, gate, turn, weights: np.ndarray) -> float:
    """What ``mix_scores`` does, for one row."""
    exp, log1p, total = math.exp, math.log1p, 0.0
    a, b, c = (w.tolist() for w in weights.T)
    sign = 2.0 * turn - 1
    for g, x, y, z in zip(gate.tolist(), *[(v * sign).tolist() for v in stretched]):
        margin = a[g] * x + b[g] * y + c[g] * z
        margin = -80.0 if margin < -80 else 80.0 if margin > 80 else margin
        odds = exp(-margin)
        total -= log1p(odds)
        pull = RATE * odds / (1 + odds)
        a[g] += x * pull
        b[g] += y * pull
        c[g] += z * pull
    return total


def cells_of(stretched, gate, turn) -> np.ndarray:
    """Cell of each decision: gate, level of each stretched prediction, branch."""
    cell = gate.astype(np.int64)
    for x in stretched:
        level = np.rint(np.clip(x, -(LEVELS // 2) * WIDTH, LEVELS // 2 * WIDTH) / WIDTH).astype(np.int64)
        cell = cell * LEVELS + level + LEVELS // 2
    return cell * 2 + turn


def cell_values(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predictions (cells, contexts), gate and branch of cells."""
    turn, rest = cell % 2, cell // 2
    x = np.empty((len(cell), CONTEXTS))
    for k in reversed(range(CONTEXTS)):
        x[:, k] = (rest % LEVELS - LEVELS // 2) * WIDTH
        rest = rest // LEVELS
    return x, rest, turn


def fitted(cell: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Gate weights of a logistic regression on counted cells, by Newton steps until they settle."""
    x, gate, turn = cell_values(cell)
    prior = np.full((GATES, CONTEXTS), START_WEIGHT)

    def loss(w):
        margin = (2 * turn - 1) * (w[gate] * x).sum(axis=1)
        return np.bincount(gate, n * np.logaddexp(0, -margin), GATES) + 5.0 * ((w - prior) ** 2).sum(axis=1)

    weights, now = prior.copy(), loss(prior)
    while True:
        p = 1 / (1 + np.exp(-np.clip((weights[gate] * x).sum(axis=1), -30, 30)))
        miss, spread = n * (turn - p), n * p * (1 - p)
        slope = np.stack([np.bincount(gate, miss * x[:, k], GATES) for k in range(CONTEXTS)], axis=1)
        bend = np.empty((GATES, CONTEXTS, CONTEXTS))
        for j in range(CONTEXTS):
            for k in range(CONTEXTS):
                bend[:, j, k] = np.bincount(gate, spread * x[:, j] * x[:, k], GATES)
        slope = slope - 10.0 * (weights - prior)
        step = np.linalg.solve(bend + 10.0 * np.eye(CONTEXTS), slope[:, :, None])[:, :, 0]
        # Gates are independent and convex: a step that does not lower its loss is halved.
        while np.abs(step).max() >= SETTLED:
            after = loss(weights + step)
            worse = after > now * (1 + 1e-12)
            if not worse.any():
                break
            step[worse] /= 2
        else:
            return weights
        weights, now = weights + step, after


START_WEIGHT = 0.35


def count_words(texts: DataFrame) -> DataFrame:
    """``kind, code, n``: words by hash (0), bytes of words and their stops (1), ends (2)."""
    def run(batches):
        held, size = [], 0
        letters, ends = np.zeros(257, np.int64), 0

        def flush():
            codes, place = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            n = np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64)
            return codes, n

        def rows(kind, codes, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), kind, np.int32)), pa.array(codes.view(np.int64)),
                 pa.array(n)], ["kind", "code", "n"])

        for batch in batches:
            for _, _, chunk in chunks(batch.column(0), lower=True):
                hashes = chunk.word_hashes()
                letters[:256] += np.bincount(chunk.data[~IS_SPACE[chunk.data]], minlength=256)
                letters[256] += len(hashes)
                ends += chunk.n
                held.append(np.unique(hashes, return_counts=True))
                size += len(held[-1][0])
                if size > 1 << 20:
                    held = [flush()]
                    size = len(held[0][0])
                    if size > 1 << 19:
                        yield rows(0, *held[0])
                        held, size = [], 0
        if size:
            yield rows(0, *flush())
        if ends:
            yield rows(1, np.arange(257, dtype=np.int64), letters)
            yield rows(2, np.zeros(1, np.int64), np.array([ends]))

    return (texts.mapInArrow(run, "kind int, code long, n long")
            .groupBy("kind", "code").agg(F.sum("n").alias("n")))


def most_frequent(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words, ``TOP_WORDS`` at most."""
    level = F.floor(8 * F.log2("n")).cast("int")
    sizes = words.groupBy(level.alias("level")).count().collect()
    least, total = 1 << 30, 0
    for r in sorted(sizes, key=lambda r: -r["level"]):
        if total + r["count"] > TOP_WORDS:
            break
        least, total = r["level"], total + r["count"]
    top = words.filter(level >= least).select("code", "n").toPandas()
    codes, n = top["code"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(codes)
    return codes[order], n[order]


def count_decisions(texts: DataFrame, coder) -> list[np.ndarray]:
    """The predictors' tables, summed over all training texts.

    Each task sends the blocks of its own counts, compressed; they are summed
    one after another, so a task of the sum holds a few blocks at a time.
    """
    width = 2 << BLOCK_BITS

    def count(batches):
        seen = np.zeros((CONTEXTS, 2 << TABLE_BITS), dtype=np.uint32)
        some = False
        for batch in batches:
            for _, _, chunk in chunks(batch.column(0), lower=True, limit=CHUNK_BYTES):
                slots, turn, _, _ = coder.value.decisions(chunk)
                some = True
                for k, slot in enumerate(slots):
                    np.add.at(seen[k], slot * np.uint32(2) + turn.astype(np.uint32), np.uint32(1))
        for k in range(CONTEXTS if some else 0):
            for block in range((2 << TABLE_BITS) // width):
                part = seen[k, block * width:(block + 1) * width]
                if part.any():
                    planes = np.ascontiguousarray(part.view(np.uint8).reshape(-1, 4).T)
                    yield pa.RecordBatch.from_pydict({
                        "context": pa.array([k], pa.int32()), "block": pa.array([block], pa.int32()),
                        "counts": [pa.compress(planes.tobytes(), "zstd", asbytes=True)]})

    def add(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, block, blob in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                planes = np.frombuffer(pa.decompress(blob, 4 * width, "zstd", asbytes=True), np.uint8)
                part = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
                if (k, block) in sums:
                    sums[k, block] += part
                else:
                    sums[k, block] = part.astype(np.int64)
        for (k, block), part in sums.items():
            packed = pack(part[0::2], part[1::2])
            yield pa.RecordBatch.from_pydict({
                "context": pa.array([k], pa.int32()), "block": pa.array([block], pa.int32()),
                "entries": [packed.tobytes()]})

    blobs = texts.mapInArrow(count, "context int, block int, counts binary")
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables = [np.zeros(1 << TABLE_BITS, np.uint16) for _ in range(CONTEXTS)]
    # CONTEXTS * 2 ** TABLE_BITS entries of two bytes, whatever the input.
    for r in (blobs.repartition(n, "context", "block")
              .mapInArrow(add, "context int, block int, entries binary").collect()):
        at = r["block"] << BLOCK_BITS
        tables[r["context"]][at:at + (1 << BLOCK_BITS)] = np.frombuffer(bytes(r["entries"]), np.uint16)
    return tables


def count_cells(texts: DataFrame, model) -> DataFrame:
    """``cell``, ``n``: all decisions of all texts by cell; each task sends a cell once."""
    size = GATES * LEVELS ** CONTEXTS * 2

    def run(batches):
        coder, tables = model.value
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for _, _, chunk in chunks(batch.column(0), lower=True, limit=CHUNK_BYTES):
                slots, turn, is_byte, _ = coder.decisions(chunk)
                x, gate = predictions(tables, slots, turn, is_byte, True)
                total += np.bincount(cells_of(x, gate, turn), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    return texts.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def start_weights(texts: DataFrame, model) -> np.ndarray:
    """Gate weights of a logistic regression over all decisions of all training texts, their
    predictions quantised. The driver takes the counted cells, a million at most."""
    found = count_cells(texts, model).toPandas().sort_values("cell")
    return fitted(found["cell"].to_numpy(np.int64), found["n"].to_numpy(np.float64))


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every whole text by a model of the rows that ``train`` selects.

    ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (unigrams, log10), ``score`` (log10) and ``bits_per_byte``.
    """
    spark = docs.sparkSession
    texts = docs.filter(train).select(text)
    path = scratch_path(spark, "lm-words")
    count_words(texts).write.parquet(path)
    counted = spark.read.parquet(path)
    words = counted.filter("kind = 0").select("code", "n")
    kinds, total_words = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    letters, ends = np.zeros(257, np.int64), 0
    for r in counted.filter("kind > 0").collect():  # 257 bytes and one count of ends
        if r["kind"] == 1:
            letters[r["code"]] = r["n"]
        else:
            ends = r["n"]
    train_tokens, distinct = total_words + ends, kinds + (ends > 0)
    divisor = train_tokens + 0.5 * (distinct + 1)
    codes, n = most_frequent(words)
    coder = Coder(codes, n, ends, letters)
    tables = count_decisions(texts, spark.sparkContext.broadcast(coder))
    model = spark.sparkContext.broadcast((coder, tables))
    weights = start_weights(texts, model)
    top = spark.sparkContext.broadcast((codes, n))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        coder, tables = model.value
        known_codes, known = top.value
        end_score = np.log10((ends + 0.5) / divisor)
        for batch in batches:
            # Texts of like length go side by side.
            batch = batch.take(pc.sort_indices(pc.fill_null(pc.binary_length(batch.column(2)), 0)))
            for first, end, chunk in chunks(batch.column(2), lower=True, limit=SCORE_BYTES):
                slots, turn, is_byte, bounds = coder.decisions(chunk)
                x, gate = predictions(tables, slots, turn, is_byte, False)
                del slots
                found = mix_scores(x, gate, turn, bounds, weights) / np.log(10)
                hashes, rows = chunk.word_hashes(), chunk.words()[2]
                count = np.zeros(len(hashes), np.int64)
                if len(known_codes):
                    at = np.minimum(np.searchsorted(known_codes, hashes), len(known_codes) - 1)
                    count = np.where(known_codes[at] == hashes, known[at], 0)
                frequent = count > 0
                base = np.bincount(rows[frequent], np.log10((count[frequent] + 0.5) / divisor),
                                   chunk.n) + end_score
                rare = np.concatenate([[0], np.cumsum(np.bincount(rows[~frequent], minlength=chunk.n))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first),
                     batch.column(1).slice(first, end - first),
                     pa.array(chunk.word_counts() + 1, pa.int64()),
                     pa.array(np.bincount(rows[frequent], minlength=chunk.n) + (ends > 0), pa.int64()),
                     pa.array(base), pa.array(found), pa.array(np.diff(chunk.offsets), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(rare, pa.int32()),
                                              pa.array(hashes[~frequent].view(np.int64)))],
                    ["_key", "held_out", "n_tokens", "_known", "_base", "score", "_bytes", "_rare"])

    path = scratch_path(spark, "lm-scores")
    (docs.select(key, ~train, text).mapInArrow(
        run, f"_key {kind}, held_out boolean, n_tokens long, _known long, _base double, "
             "score double, _bytes long, _rare array<long>")
     .withColumn("_row", F.monotonically_increasing_id()).write.parquet(path))
    scored = spark.read.parquet(path)
    count = F.coalesce("n", F.lit(0))
    rare = (scored.select("_row", F.explode("_rare").alias("code")).join(words, "code", "left")
            .groupBy("_row").agg(F.sum(F.log10((count + 0.5) / F.lit(float(divisor)))).alias("_more"),
                                 F.sum((count > 0).cast("long")).alias("_more_known")))
    return (scored.drop("_rare").join(rare, "_row", "left").select(
        F.col("_key").alias(key), "held_out", "n_tokens",
        (F.col("_known") + F.coalesce("_more_known", F.lit(0))).alias("n_known"),
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.greatest("_bytes", F.lit(1)))
        .alias("bits_per_byte")))

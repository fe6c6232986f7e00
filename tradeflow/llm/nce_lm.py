"""Language-model scoring with a log-bilinear neural model.

Tokens are the A-Z-lowered words of a text and one end. Word counts of all
training documents are a table. The model predicts a symbol, which is one of
the ``words`` most frequent words or one of ``buckets`` classes of all other
words (by their last two bytes): with context vectors r and word vectors q,

    s(w | a, b) = (r1[a] + r2[b]) . q[w] + bias[w]

for the symbols a, b before w. It is trained in numpy by noise-contrastive
estimation over the symbol trigram counts of all training documents. A mixed
trigram's first bits name its piece; tasks count the trigrams they read and
hand on one row a piece, and equal trigrams are added up piece by piece. Pieces
are dealt to learners, whose number follows from the number of training tokens
alone. A learner takes minibatch steps from the shared parameters over one of
``PARTS`` parts of its pieces, then all are averaged by weight; a round is
``PARTS`` such steps, and so the whole table, and there are ``rounds`` rounds. Learners,
their order and their sums do not depend on how the documents lie in files or
on the number of tasks, and so neither do the scores.
Probabilities are normalised: exp(s) factors into a term in (a, w) and one in
(b, w), so one matrix product gives the sum for every context. A word of a
class has the class's probability times its smoothed share of the class.

Words beyond the ``table_words`` most frequent are not in the table that tasks
hold; their counts come by a join on the word, so every token has its exact
count. The join has no hot key, as frequent words never reach it.

Cases: null or empty text is the end alone. No training documents: all counts
are zero, and both scores follow from the smoothing. Repeated rows count each
time. A null id is never held out. Only the id (cast to a long) and text columns are read. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import kept_in_worker, one_row, saved, text_of

END = b"\n"
ALPHA = 0.1
WORDS = 960
BUCKETS = 63
TABLE_WORDS = 200_000
DIM = 16
ROUNDS = 2
BATCH = 2048
NOISE = 32
#: Training tokens of a learner, about; the most learners there are; parts of a learner after which all are averaged.
LEARNER, MOST_LEARNERS = 6_000_000, 1024
PARTS = 2
#: Bits of a trigram's code, of its place in a piece; and what codes are multiplied by, modulo all of them, and back.
CODE_BITS, PLACE_BITS = 30, 20
MIX = 0x2545F491
UNMIX = pow(MIX, -1, 1 << CODE_BITS)
RATE = 0.05
#: Distinct words, and tokens, that a counting task holds before it hands them on.
FLUSH_WORDS, FLUSH_TOKENS = 200_000, 4_000_000
#: Tokens that are looked up together.
TOGETHER = 30_000
#: Sums of parameters are taken in whole units of this size, so that their order does not matter.
UNIT = 1 << 24


def tokens_of(text: str) -> list[bytes]:
    words = text.encode("utf-8").lower().split()  # bytes: only ASCII case and white space
    words.append(END)
    return words


def bucket_of(word: bytes, buckets: int) -> int:
    tail = word[-2:]
    return (tail[0] * 131 + tail[-1] * 31 + len(tail)) % buckets


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        got = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         names=["word", "c"])
        seen.clear()
        return got
    for b in batches:
        for cell in b.column(0):
            seen.update(tokens_of(cell.as_py()))
            if len(seen) > FLUSH_WORDS:
                yield out()
    yield out()


def _symbols(held) -> "Symbols":
    """The task's symbols, made once in each worker: a broadcast value stays the same object there."""
    kept = kept_in_worker()
    if kept.get("symbols", (None, None))[0] is not held.value:
        kept["symbols"] = (held.value, Symbols(*held.value))
    return kept["symbols"][1]


class _Places(dict):
    """Places of words in the table; -1 for all others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def _flat(cells) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Texts to (first text, tokens of some texts in a row, where each begins), ``TOGETHER`` tokens or one text at a time."""
    words, starts, first = [], [0], 0
    for i, cell in enumerate(cells):
        words += tokens_of(cell.as_py())
        starts.append(len(words))
        if len(words) >= TOGETHER:
            yield first, words, np.array(starts)
            words, starts, first = [], [0], i + 1
    if words:
        yield first, words, np.array(starts)


class Symbols:
    """The frequent words' table: symbol, log10 count; and the classes' sizes."""

    def __init__(self, table: list[tuple[bytes, int]], mass: np.ndarray, kinds: np.ndarray, words: int, buckets: int):
        self.words, self.buckets = words, buckets
        self.size = words + buckets
        self.index = _Places((w, i) for i, (w, _) in enumerate(table))
        self.symbol = np.array([i if i < words else words + bucket_of(w, buckets) for i, (w, _) in enumerate(table)]
                               or [0], np.int64)
        self.log_count = np.log10(np.array([c for _, c in table] or [0], np.float64) + ALPHA)
        # log10 of a class's smoothed total; a word that is its own symbol has no share to take.
        share = np.log10(mass + ALPHA * (kinds + 1))
        self.log_share = np.concatenate([np.zeros(words), share])
        self.counts = np.concatenate([np.array([c for _, c in table[:words]] + [0] * (words - len(table[:words])),
                                               np.float64), mass])
        self.end = self.of([END])[0][0]

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words, and their places in the table (-1: not in it)."""
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        symbols = self.symbol[at]
        rare = np.flatnonzero(at < 0)
        if len(rare):
            symbols[rare] = [self.words + bucket_of(words[i], self.buckets) for i in rare.tolist()]
        return symbols, at

    def before(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two symbols before each of some texts' tokens; a text begins after two ends, and its last token is one."""
        line = np.concatenate([[self.end, self.end], symbols])
        a, b = line[1:-1], line[:-2].copy()
        b[starts[:-1]] = self.end
        return a, b


def mixed(code: np.ndarray, by: int = MIX) -> np.ndarray:
    """Codes mixed, or with ``UNMIX`` back: one to one, and neighbouring contexts part."""
    return (code.astype(np.uint64) * np.uint64(by) & np.uint64((1 << CODE_BITS) - 1)).astype(np.uint32)


_PIECES = "piece int, codes binary, counts binary"


def piece_rows(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Mixed codes in order, and their counts, to one row a piece."""
    piece = codes >> np.uint32(PLACE_BITS)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(piece)) + 1, [len(codes)]])
    runs = [slice(i, j) for i, j in zip(cut.tolist(), cut[1:].tolist()) if i < j]
    codes, counts = codes.astype("<u4"), counts.astype("<i8")
    return pa.RecordBatch.from_arrays(
        [pa.array([int(piece[r.start]) for r in runs], pa.int32()), pa.array([codes[r].tobytes() for r in runs], pa.binary()),
         pa.array([counts[r].tobytes() for r in runs], pa.binary())], names=["piece", "codes", "counts"])


def _trigrams(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = _symbols(held)
        codes: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            found = piece_rows(*np.unique(np.concatenate(codes), return_counts=True))
            codes.clear()
            return found
        total = 0
        for b in batches:
            for _, words, starts in _flat(b.column(0)):
                s, _ = symbols.of(words)
                a, c = symbols.before(s, starts)
                codes.append(mixed(((a << 10) | c) << 10 | s))
                total += len(s)
                if total > FLUSH_TOKENS:
                    yield out()
                    total = 0
        if codes:
            yield out()
    return run


class _Sum:
    """Counts of codes, added up whenever as much is waiting as is there."""

    def __init__(self):
        self.codes, self.counts, self.waiting, self.n = np.zeros(0, np.uint32), np.zeros(0, np.int64), [], 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((codes, counts))
        self.n += len(codes)
        if self.n > max(len(self.codes), 100_000):
            self.settle()

    def settle(self) -> None:
        codes, place = np.unique(np.concatenate([self.codes] + [c for c, _ in self.waiting]), return_inverse=True)
        counts = np.zeros(len(codes), np.int64)
        np.add.at(counts, place, np.concatenate([self.counts] + [n for _, n in self.waiting]))
        self.codes, self.counts, self.waiting, self.n = codes, counts, [], 0


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(learner, part, piece, codes, counts) rows in order to one row a learner and part."""
    key, piece, sums, done = None, None, None, []

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
             pa.array([np.concatenate([c for c, _ in done]).astype("<u4").tobytes()], pa.binary()),
             pa.array([np.concatenate([n for _, n in done]).astype("<i8").tobytes()], pa.binary())],
            names=["learner", "part", "codes", "counts"])
    for b in batches:
        for learner, part, p, codes, counts in zip(*(b.column(i) for i in range(5))):
            at = (learner.as_py(), part.as_py())
            if piece is not None and (at, p.as_py()) != (key, piece):
                sums.settle()
                done.append((sums.codes, sums.counts))
                piece = None
            if at != key:
                if done:
                    yield row()
                key, done = at, []
            if piece is None:
                piece, sums = p.as_py(), _Sum()
            sums.add(np.frombuffer(codes.as_buffer(), "<u4"), np.frombuffer(counts.as_buffer(), "<i8"))
    if piece is not None:
        sums.settle()
        done.append((sums.codes, sums.counts))
        yield row()


def learners(pieces: DataFrame, tokens: int) -> DataFrame:
    """pieces: as :func:`piece_rows` gives them, any number a piece. One row a learner and part: mixed codes, counts."""
    number = min(MOST_LEARNERS, max(1, -(-tokens // LEARNER)))
    learner, part = F.pmod("piece", F.lit(number)).cast("int"), F.pmod(F.floor(F.col("piece") / number), F.lit(PARTS)).cast("int")
    dealt = pieces.select(learner.alias("learner"), part.alias("part"), "piece", "codes", "counts")
    dealt = dealt.repartition(number * PARTS, "learner", "part").sortWithinPartitions("learner", "part", "piece")
    return saved(dealt.mapInArrow(_merge, "learner int, part int, codes binary, counts binary"), "learners")


def start_parameters(size: int, counts: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    p = (counts + 1) / (counts.sum() + size)
    return {"r1": rng.normal(0, 0.1, (size, DIM)), "r2": rng.normal(0, 0.1, (size, DIM)),
            "q": rng.normal(0, 0.1, (size, DIM)), "bias": np.log(p)[:, None]}


def _add_rows(size: int, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(rows, values[:, d], size) for d in range(values.shape[1])], axis=1)


def nce_steps(par: dict[str, np.ndarray], past: dict[str, np.ndarray], code: np.ndarray, n: np.ndarray,
              counts: np.ndarray, seed: int) -> None:
    """One pass of minibatch steps (in place) over trigram codes with counts n; past: sums of squared steps."""
    rng = np.random.default_rng(seed)
    size = len(counts)
    noise_p = (counts + 1) / (counts.sum() + size)
    log_noise = np.log(NOISE * noise_p)
    order = rng.permutation(len(code))
    for at in range(0, len(code), BATCH):
        pick = order[at:at + BATCH]
        a, b, w = code[pick] >> 20, (code[pick] >> 10) & 1023, code[pick] & 1023
        weight = n[pick] / n[pick].sum()
        noise = rng.choice(size, NOISE, p=noise_p)
        h = par["r1"][a] + par["r2"][b]
        good = 1 / (1 + np.exp(np.clip((h * par["q"][w]).sum(1) + par["bias"][w, 0] - log_noise[w], -30, 30)))
        good *= weight
        bad = h @ par["q"][noise].T + par["bias"][noise, 0] - log_noise[noise]
        bad = weight[:, None] / (1 + np.exp(-np.clip(bad, -30, 30)))
        h_step = good[:, None] * par["q"][w] - bad @ par["q"][noise]
        q_step = _add_rows(size, w, good[:, None] * h)
        np.add.at(q_step, noise, -(bad.T @ h))
        b_step = np.bincount(w, good, size) - np.bincount(noise, bad.sum(0), size)
        for name, step in (("r1", _add_rows(size, a, h_step)), ("r2", _add_rows(size, b, h_step)),
                           ("q", q_step), ("bias", b_step[:, None])):
            past[name] += step * step
            par[name] += RATE * step / np.sqrt(past[name])


def _learn(counts: np.ndarray, held, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for learner, codes, ns in zip(*(b.column(i) for i in range(3))):
                learner = learner.as_py()
                code = mixed(np.frombuffer(codes.as_buffer(), "<u4"), UNMIX).astype(np.int64)
                n = np.frombuffer(ns.as_buffer(), "<i8")
                own = {k: v.copy() for k, v in held.value[0].items()}
                past = {k: v.copy() for k, v in held.value[1].items()}
                nce_steps(own, past, code, n.astype(np.float64), counts, seed + learner)
                flat = np.concatenate([x[k] if k != "bias" else np.tile(x[k], (1, DIM)) for x in (own, past)
                                       for k in ("r1", "r2", "q", "bias")])
                rows = np.rint(flat * UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(rows)), pa.int32()), pa.array(np.full(len(rows), int(n.sum())), pa.int64()),
                     pa.array(list(rows), pa.list_(pa.int64()))], names=["row", "weight", "v"])
    return run


def train(table: DataFrame, counts: np.ndarray, *, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Parameter averaging over the learners (:func:`learners`); counts: of each symbol."""
    size = len(counts)
    par = start_parameters(size, counts)
    past = {k: np.full(v.shape, 1e-6) for k, v in par.items()}
    for step in range(rounds * PARTS):
        held = table.sparkSession.sparkContext.broadcast((par, past))
        own = table.where(F.col("part") == step % PARTS).select("learner", "codes", "counts").mapInArrow(
            _learn(counts, held, 1_000_003 * step), "row int, weight long, v array<long>")
        sums = [F.sum(F.get("v", F.lit(d)).cast("decimal(38,0)") * F.col("weight")).alias(f"v{d}") for d in range(DIM)]
        rows = own.groupBy("row").agg(F.sum("weight").alias("weight"), *sums).collect()  # 8 * size rows
        if not rows:
            continue
        flat = np.zeros((8 * size, DIM))
        for x in rows:
            flat[x["row"]] = [float(v) / (float(x["weight"]) * UNIT) for v in x[2:]]
        parts = [flat[i * size:(i + 1) * size] for i in range(8)]
        par, past = ({"r1": p[0], "r2": p[1], "q": p[2], "bias": p[3][:, :1]} for p in (parts[:4], parts[4:]))
        past = {k: np.maximum(v, 1e-6) for k, v in past.items()}
    return par


class Model:
    """Normalised symbol log10 probabilities."""

    def __init__(self, par: dict[str, np.ndarray]):
        one = par["r1"] @ par["q"].T
        two = par["r2"] @ par["q"].T + par["bias"][:, 0]
        top_one, top_two = one.max(1, keepdims=True), two.max(1, keepdims=True)
        z = np.exp(one - top_one) @ np.exp(two - top_two).T  # [a, b], all contexts at once
        # Single precision: three tables of all pairs stay near the processor.
        self.size = len(one)
        self.one, self.two = one.astype(np.float32).ravel(), two.astype(np.float32).ravel()
        self.log_z = (np.log(z) + top_one + top_two.T).astype(np.float32).ravel()

    def log10(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        n = self.size
        found = self.one.take(a * n + w).astype(np.float64) + self.two.take(b * n + w) - self.log_z.take(a * n + b)
        return found / np.log(10)


_SCORED = ("id long, row_id long, n_tokens long, known long, base double, model double, "
           "rare array<struct<word: binary, n: long>>")


def _score(held, par):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, model = _symbols(held), Model(par.value)
        for batch in batches:
            known, base, score = (np.zeros(batch.num_rows) for _ in range(3))
            n_tokens, ends, rare, times = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows + 1, np.int32), [], []
            for first, words, starts in _flat(batch.column(2)):
                n = np.diff(starts)
                texts, own = slice(first, first + len(n)), np.repeat(np.arange(len(n)), n)
                s, at = symbols.of(words)
                there = at >= 0
                logs = np.where(there, symbols.log_count[at], 0.0)
                each = model.log10(*symbols.before(s, starts), s) - symbols.log_share[s] + np.where(s >= symbols.words, logs, 0.0)
                n_tokens[texts] = n
                for out, values in ((known, there), (base, logs), (score, each)):
                    out[texts] = np.bincount(own, values, len(n))
                away = np.flatnonzero(~there)
                for i, j, t in zip(np.searchsorted(away, starts[:-1]).tolist(), np.searchsorted(away, starts[1:]).tolist(),
                                   range(first, first + len(n))):
                    if i < j:
                        rest = Counter(words[k] for k in away[i:j].tolist())
                        rare += rest
                        times += rest.values()
                    ends[t + 1] = len(rare)
            lone = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_tokens), pa.array(known.astype(np.int64)),
                 pa.array(base), pa.array(score), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lone)],
                names=["id", "row_id", "n_tokens", "known", "base", "model", "rare"])
    return run


def _bucket(word, buckets: int):
    """:func:`bucket_of` as a column."""
    def byte(n):
        return F.conv(F.hex(F.substring(word, n, 1)), 16, 10).cast("int")
    n = F.length(word)
    return F.pmod(byte(F.greatest(n - 1, F.lit(1))) * 131 + byte(n) * 31 + F.least(n, F.lit(2)), F.lit(buckets))


def frequent_words(vocabulary: DataFrame, limit: int) -> list[tuple[bytes, int]]:
    """At most ``limit`` most frequent words, by count and word: all whose count reaches the lowest step of a
    logarithmic scale that so many words reach. (A sorted limit would send that many rows from every task.)"""
    step = F.floor(F.log2("c") * 16).cast("int")
    sizes = sorted(vocabulary.groupBy(step.alias("s")).agg(F.count(F.lit(1))).collect(), reverse=True)  # a row for each step
    low, n = None, 0
    for s, k in sizes:
        if n + k > limit:
            break
        low, n = s, n + k
    if low is None:
        return []
    return sorted(((bytes(w), c) for w, c in vocabulary.where(step >= low).collect()), key=lambda x: (-x[1], x[0]))


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
              buckets: int = BUCKETS, table_words: int = TABLE_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if words + buckets > 1024:
        raise ValueError("trigram codes have ten bits for a symbol")
    spark = docs.sparkSession
    out = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False))
    d = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"), out.alias("held_out"))
    train_text = d.where(~F.col("held_out")).select("text")

    vocabulary = saved(train_text.mapInArrow(_count_words, "word binary, c long").groupBy("word")
                       .agg(F.sum("c").alias("c")), "vocabulary")
    total, kinds = one_row(vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))))
    table = frequent_words(vocabulary, table_words)
    own = [(w,) for w, _ in table[:words]]
    rest = vocabulary
    if own:
        rest = vocabulary.join(F.broadcast(spark.createDataFrame(own, "word binary")), "word", "left_anti")
    mass, types = np.zeros(buckets), np.zeros(buckets)
    for b, m, t in rest.groupBy(_bucket(F.col("word"), buckets).alias("b")).agg(
            F.sum("c"), F.count(F.lit(1))).collect():  # one row for each class
        mass[b], types[b] = m, t
    symbols = (table, mass, types, words, buckets)
    held = spark.sparkContext.broadcast(symbols)  # at most `table_words` words

    table = learners(train_text.mapInArrow(_trigrams(held), _PIECES), total)
    par = spark.sparkContext.broadcast(train(table, Symbols(*symbols).counts, rounds=rounds))

    rows = d.select("id", F.monotonically_increasing_id().alias("row_id"), "text")
    scored = saved(rows.mapInArrow(_score(held, par), _SCORED), "scored")
    lone = scored.select("row_id", F.explode("rare").alias("r")).select("row_id", "r.word", F.col("r.n").alias("n"))
    # Words that no training text has are not in the vocabulary: count zero.
    joined = lone.join(vocabulary, "word", "left").select("row_id", "n", F.coalesce("c", F.lit(0)).alias("c"))
    extra = joined.groupBy("row_id").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known_more"),
        F.sum(F.round(F.col("n") * F.log10(F.col("c") + F.lit(ALPHA)) * (1 << 30)).cast("decimal(38,0)")).alias("logs"))
    logs = F.coalesce(F.col("logs").cast("double") / (1 << 30), F.lit(0.0))  # whole units: their order does not matter
    floor = float(np.log10(total + ALPHA * (kinds + 1)))
    return scored.drop("rare").join(extra, "row_id", "left").select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.crc32(F.col("id").cast("string")) % 10 == 0, F.lit(False)).alias("held_out"),
        "n_tokens", (F.col("known") + F.coalesce("known_more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("model") + logs).alias("score"))

"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

The network's units are the commonest training words, as many as the cube root of the training text allows, so that the
vocabulary grows with the corpus; classes of last letters, which stand for all other words; and the end of a text. A
unit's probability after the two units before it is that of its class of units times its own within that class, both
log-bilinear in one context vector. Within a class of last letters a word has its share of the training counts. So
every token has a normalised probability, known or not.

Counts are exact: documents are dealt into chunks, a chunk sends its distinct words with their training counts, packed
by bucket of words, and a bucket adds them up word by word and answers each chunk with the totals, in the order sent.
"""

from __future__ import annotations

import uuid
import zlib
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import held, materialise, pieces
from quillgraph.llm.langid import held_out

#: Words with a unit of their own: the cube root of the training text's bytes, times this. The network is
#: broadcast: about 1 MB for 1 GB of text, 45 MB for 100 TB.
WORDS_BY_ROOT = 4
#: Classes of the other words, by a hash of their last letters.
SUFFIXES = 256
SUFFIX_BYTES = 3
DIM = 32
NOISE = 16
NOISE_IN_CLASS = 8
BATCH = 8192
RATE = 0.1
#: Training text that the driver learns from first, in distinct documents of at most a sixteenth of it.
FIRST_BYTES = 4 << 20
#: Commonest words of that text, at most: their counts travel by place, not by name.
HOT = 1 << 15
SLAB = 4096
CHUNK_BYTES = 12 << 20
#: Bytes of text whose distinct words meet in one bucket.
BUCKET_BYTES = 16 << 20
REMEMBER = 200_000
TASKS_MERGED = 64
#: Parameters travel in parts of so many numbers.
PART = 1 << 18
STEP_TOKENS = 1 << 16


def split(text: str | None) -> list[bytes]:
    """Words without ASCII white space, A to Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def suffix(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX_BYTES:]) % SUFFIXES


class Index(dict):
    """Numbers words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class ChunkWords:
    """The distinct words of a chunk: the hot ones by place, then the others by hash, which also deals them into buckets."""

    def __init__(self, texts: list[str | None], hot: list[bytes], buckets: int):
        index = Index(zip(hot, range(len(hot))))
        parts = []
        for t in texts:
            w = split(t)
            parts.append(np.fromiter(map(index.__getitem__, w), np.int32, len(w)))
        self.size = np.array([len(p) for p in parts], np.int64)
        self.tokens = np.concatenate(parts) if parts else np.empty(0, np.int32)
        self.hot, self.words = len(hot), list(index)
        rest = self.words[self.hot :]
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, rest), np.uint64, len(rest))
        order = np.argsort(h, kind="stable")
        for k in np.flatnonzero(h[order][1:] == h[order][:-1]).tolist():  # equal hashes go by word, however the chunk came
            same = np.flatnonzero(h[order] == h[order[k]])
            order[same] = sorted(order[same].tolist(), key=rest.__getitem__)
        self.order, self.bucket = order, ((h[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _send(pdf: pd.DataFrame, hot, buckets: int) -> pd.DataFrame:
    """A chunk's distinct words and their training counts: by bucket, and for the hot words by slab as bucket -1 - slab."""
    c = ChunkWords(pdf["_text"].tolist(), hot.value, buckets)
    n = np.bincount(c.tokens[np.repeat(pdf["_train"].to_numpy(bool), c.size)], minlength=len(c.words))
    chunk, out = int(pdf["_chunk"].iloc[0]), []
    for at in range(0, c.hot, SLAB):
        slab = n[at : min(at + SLAB, c.hot)]
        if slab.any():
            out.append((-1 - at // SLAB, chunk, b"", slab.astype(np.uint32).tobytes()))
    rest, n = c.words[c.hot :], n[c.hot :][c.order].astype(np.uint32)
    ends = [0, *np.flatnonzero(np.diff(c.bucket)).tolist()]
    cuts = [0, *(x + 1 for x in ends[1:]), len(rest)]
    order = c.order.tolist()
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            out.append((int(c.bucket[a]), chunk, b" ".join([rest[i] for i in order[a:b]]), n[a:b].tobytes()))
    return pd.DataFrame(out, columns=["bucket", "chunk", "words", "counts"])


def _sum_hot(batches):
    total: dict[int, np.ndarray] = {}
    for p in batches:
        for b, x in zip(p["bucket"].tolist(), p["counts"]):
            n = np.frombuffer(x, np.uint32)
            total[b] = total[b] + n if b in total else n.astype(np.int64)
    for b, n in total.items():
        at = np.flatnonzero(n)
        yield pd.DataFrame({"at": (-1 - b) * SLAB + at, "n": n[at]})


def _merge_words(pdf: pd.DataFrame, least: int) -> pd.DataFrame:
    """A bucket's totals: for each chunk those of its words in order; once, the sums by class and the words with at least ``least``."""
    index, places, total = Index(), [], np.zeros(1 << 12, np.int64)
    for blob, counts in zip(pdf["words"], pdf["counts"]):
        w = blob.split(b" ")
        at = np.fromiter(map(index.__getitem__, w), np.int32, len(w))
        if len(index) > len(total):
            total = np.append(total, np.zeros(max(len(index) - len(total), len(total)), np.int64))
        total[at] += np.frombuffer(counts, np.uint32)  # a chunk names a word once
        places.append(at)
    words, total = list(index), total[: len(index)]
    known = np.flatnonzero(total)
    c = np.fromiter((suffix(words[i]) for i in known.tolist()), np.int64, len(known))
    n, v = np.bincount(c, weights=total[known], minlength=SUFFIXES), np.bincount(c, minlength=SUFFIXES)
    sums = [{"c": int(k), "n": int(n[k]), "v": int(v[k])} for k in np.flatnonzero(v)]
    top = [{"w": words[i], "n": int(total[i])} for i in np.flatnonzero(total >= least)]
    out = pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "n": [total[at].tobytes() for at in places], "sums": None, "top": None}, dtype=object)
    out.at[0, "sums"], out.at[0, "top"] = sums, top
    return out


class Vocabulary:
    """Units by falling count, cut into classes of near equal sums of the counts' roots; one more stands before a text begins."""

    def __init__(self, words: list[tuple[bytes, int]], suffix_n: np.ndarray, ends: int):
        n = np.concatenate(([x for _, x in words], suffix_n, [ends])).astype(np.float64)
        order = np.argsort(-n, kind="stable")
        place = np.empty(len(n), np.int32)
        place[order] = np.arange(len(n))
        self.words = dict(zip((w for w, _ in words), place.tolist()))
        self.suffixes, self.end, self.size, self.n = place[len(words) : -1].tolist(), int(place[-1]), len(n), n[order]
        self.rare = np.full(len(n), -1)
        self.rare[self.suffixes] = np.arange(SUFFIXES)
        root = np.cumsum(np.sqrt(self.n + 1))
        cut = np.floor(root / root[-1] * max(1, round(np.sqrt(len(n)))) * (1 - 1e-12)).astype(np.int64)
        self.class_of = np.unique(cut, return_inverse=True)[1].astype(np.int32)
        self.begin = np.searchsorted(self.class_of, np.arange(self.class_of[-1] + 2))
        self.name = uuid.uuid4().hex

    def unit(self, word: bytes) -> int:
        found = self.words.get(word)
        return self.suffixes[suffix(word)] if found is None else found

    def sequence(self, units: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each token's unit and the two before it; a text is led by two marks and closed by the end. size: words by text."""
        ends = np.cumsum(size + 3)
        s = np.full(int(ends[-1]) if len(ends) else 0, self.size, np.int32)
        words = np.ones(len(s), bool)
        words[ends - 1] = words[ends - size - 2] = words[ends - size - 3] = False
        s[ends - 1], s[words] = self.end, units
        words[ends - 1] = True
        at = np.flatnonzero(words)
        return s[at], s[at - 1], s[at - 2]


class Units(dict):
    """A word's unit, remembered for the first words seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        u = self.vocabulary.unit(word)
        if len(self) < REMEMBER:
            self[word] = u
        return u


def _order(index: np.ndarray, most: int) -> np.ndarray:
    """A stable order of indices below ``most``; 16-bit numbers sort by radix."""
    return np.argsort(index.astype(np.uint16) if most <= 1 << 16 else index, kind="stable")


def _sum_rows(index: np.ndarray, rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct indices below ``most`` and the sums of their rows."""
    order = _order(index, most)
    i = index[order]
    begin = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
    return i[begin], np.add.reduceat(rows.take(order, 0), begin, axis=0)


class LogBilinear:
    """The context is c1 * r[a] + c2 * r[b] (diagonal matrices); a class scores ctx . qc + bc, a unit in its class ctx . q + bias."""

    NAMES = ("r", "c1", "c2", "q", "bias", "qc", "bc")

    def __init__(self, vocabulary: Vocabulary, seed: int = 3):
        self.v, rng = vocabulary, np.random.default_rng(seed)
        size, classes = vocabulary.size, len(vocabulary.begin) - 1
        n = vocabulary.n + 1
        by_class = np.add.reduceat(n, vocabulary.begin[:-1])
        self.noise, self.noise_in = by_class / n.sum(), n / by_class[vocabulary.class_of]
        normal = lambda rows: rng.normal(0, 0.1, (rows, DIM)).astype(np.float32)
        self.r, self.q, self.qc = normal(size + 1), normal(size), normal(classes)
        self.c1, self.c2 = np.ones(DIM, np.float32), np.full(DIM, 0.5, np.float32)
        self.bias, self.bc = np.log(self.noise_in).astype(np.float32), np.log(self.noise).astype(np.float32)
        self.reset()

    def reset(self) -> None:
        """Forget how far each parameter has been moved."""
        self.squares = {n: np.full(getattr(self, n).shape, 1.0, np.float32) for n in self.NAMES}

    def _move(self, name: str, rows, g: np.ndarray) -> None:
        """An AdaGrad step up the gradient, on some rows of a parameter."""
        at = self.squares[name][rows] + g * g
        self.squares[name][rows] = at
        getattr(self, name)[rows] += RATE * g / np.sqrt(at)

    @staticmethod
    def _contrast(ctx, qw, good, qd, offset):
        """Gradients of telling tokens from shared noise. good: scores less log of noise, of the tokens; then its pull on each."""
        good = 1 / (1 + np.exp(good))
        bad = ctx @ -qd.T
        bad -= offset
        np.exp(bad, out=bad)
        bad += 1
        np.divide(-1, bad, out=bad)
        d = bad @ qd
        d += qw * good[:, None]
        return good, bad, d

    def step(self, w: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> None:
        """One step on a batch sorted by w: tell classes from noise drawn by frequency, and units from noise of their class."""
        v = self.v
        ra, rb = self.r.take(a, 0), self.r.take(b, 0)
        ctx = ra * self.c1 + rb * self.c2
        y = v.class_of.take(w)
        draws = np.searchsorted(self.sums, rng.random(NOISE)).clip(0, len(self.bc) - 1)
        offset = self.bc - self.log_k
        qw = self.qc.take(y, 0)
        good, bad, d_ctx = self._contrast(ctx, qw, np.einsum("ij,ij->i", ctx, qw) + offset.take(y), self.qc[draws], offset[draws])
        first = np.flatnonzero(np.concatenate(([True], y[1:] != y[:-1])))
        ends = [*first[1:].tolist(), len(y)]
        g, gb = np.zeros_like(self.qc), np.zeros_like(self.bc)
        g[y[first]], gb[y[first]] = np.add.reduceat(ctx * good[:, None], first, axis=0), np.add.reduceat(good, first)
        np.add.at(g, draws, bad.T @ ctx)
        np.add.at(gb, draws, bad.sum(0))
        self._move("qc", slice(None), g)
        self._move("bc", slice(None), gb)
        qw, pull = self.q.take(w, 0), np.empty(len(w), np.float32)
        score = np.einsum("ij,ij->i", ctx, qw) + (self.bias - self.log_in).take(w)
        units, grads, biases = [], [], []
        for i, j in zip(first.tolist(), ends):
            lo, hi = v.begin[y[i]], v.begin[y[i] + 1]
            if hi - lo == 1:
                pull[i:j] = 0
                continue
            low, high = self.sums_in[lo], self.sums_in[hi]
            draw = (np.searchsorted(self.sums_in[1:], low + rng.random(NOISE_IN_CLASS) * (high - low), side="right")).clip(lo, hi - 1)
            good, bad, d = self._contrast(ctx[i:j], qw[i:j], score[i:j], self.q[draw], (self.bias - self.log_in)[draw])
            pull[i:j] = good
            d_ctx[i:j] += d
            units.append(draw)
            grads.append(bad.T @ ctx[i:j])
            biases.append(bad.sum(0))
        begin = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        units.append(w[begin])
        grads.append(np.add.reduceat(ctx * pull[:, None], begin, axis=0))
        biases.append(np.add.reduceat(pull, begin))
        rows, g = _sum_rows(np.concatenate(units), np.column_stack((np.concatenate(grads), np.concatenate(biases))), v.size)
        self._move("q", rows, g[:, :-1])
        self._move("bias", rows, g[:, -1])
        g1, g2 = np.einsum("ij,ij->j", d_ctx, ra), np.einsum("ij,ij->j", d_ctx, rb)
        self._move("r", *_sum_rows(np.concatenate((a, b)), np.concatenate((d_ctx * self.c1, d_ctx * self.c2)), v.size + 1))
        self._move("c1", slice(None), g1)
        self._move("c2", slice(None), g2)

    def train(self, w: np.ndarray, a: np.ndarray, b: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.sums, self.sums_in = np.cumsum(self.noise), np.concatenate(([0], np.cumsum(self.noise_in)))
        self.log_k, self.log_in = np.log(NOISE * self.noise).astype(np.float32), np.log(NOISE_IN_CLASS * self.noise_in).astype(np.float32)
        order = rng.permutation(len(w))
        for at in range(0, len(w), BATCH):
            i = order[at : at + BATCH]
            i = i[_order(w[i], self.v.size)]
            self.step(w[i], a[i], b[i], rng)

    def pack(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            have = getattr(self, n)
            setattr(self, n, flat[at : at + have.size].reshape(have.shape).astype(np.float32))
            at += have.size

    @staticmethod
    def _log_sum(s: np.ndarray) -> np.ndarray:
        top = s.max() if s.size else 0
        if top > 60 or s.size and s.max(axis=1).min() < -60:
            top = s.max(axis=1)
            return top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        return np.log(np.exp(s, out=s).sum(axis=1))

    def log_probabilities(self, w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Normalised log-probabilities by batched matrix products: of the class among classes, of the unit within its class."""
        v, out = self.v, np.empty(len(w))
        for at in range(0, len(w), STEP_TOKENS):
            i = at + _order(w[at : at + STEP_TOKENS], v.size)
            u = w[i]
            y = v.class_of.take(u)
            ctx = self.r.take(a[i], 0) * self.c1
            ctx += self.r.take(b[i], 0) * self.c2
            s = ctx @ self.qc.T
            s += self.bc
            p = s[np.arange(len(y)), y] - self._log_sum(s)
            first = np.flatnonzero(np.concatenate(([True], y[1:] != y[:-1])))
            for j, k in zip(first.tolist(), [*first[1:].tolist(), len(y)]):
                lo, hi = v.begin[y[j]], v.begin[y[j] + 1]
                if hi - lo > 1:
                    s = ctx[j:k] @ self.q[lo:hi].T
                    s += self.bias[lo:hi]
                    p[j:k] += s[np.arange(k - j), u[j:k] - lo] - self._log_sum(s)
            out[i] = p
        return out


def _train(batches, shared):
    """Train the shared first network on a partition's texts; its parameters in parts, weighted by the tokens seen."""
    model = shared.value.copied()
    v, seen, waiting, n, seed = model.v, 0, [], 0, 17
    known = held(("lbl", v.name), lambda: Units(v), 60)

    def go() -> None:
        model.train(*v.sequence(np.concatenate(waiting), np.array([len(x) for x in waiting])), seed=seed)

    for p in batches:
        for text in p["_text"]:
            w = split(text)
            waiting.append(np.fromiter(map(known.__getitem__, w), np.int32, len(w)))
            n += len(w) + 1
            if n >= 400_000:
                go()
                seen, waiting, n, seed = seen + n, [], 0, seed + 1
    if waiting:
        go()
        seen += n
    if seen:
        flat, task = model.pack(), TaskContext.get().partitionId()
        for k in range(0, len(flat), PART):
            yield pd.DataFrame({"part": [k // PART], "task": [task], "n": [float(seen)], "flat": [flat[k : k + PART].tobytes()]})


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("task")  # the order of the sum decides its last bits
    total = pdf["n"].sum()
    flat = sum(np.frombuffer(x, np.float32) * (n / total) for x, n in zip(pdf["flat"], pdf["n"]))
    return pd.DataFrame({"part": pdf["part"].iloc[:1], "task": pdf["task"].iloc[:1], "n": [total], "flat": [flat.astype(np.float32).tobytes()]})


class Shared(LogBilinear):
    """What tasks start from: workers keep it for their next task, so each trains on a copy."""

    def __init__(self, model: LogBilinear):
        self.__dict__ = {k: x for k, x in model.__dict__.items() if k != "squares"}

    def copied(self) -> LogBilinear:
        model = object.__new__(LogBilinear)
        model.__dict__ = self.__dict__ | {n: getattr(self, n).copy() for n in self.NAMES}
        model.reset()
        return model


class Scorer:
    """What scoring needs besides the words' counts: the network, the shares of classes of last letters, counts of hot words, totals."""

    def __init__(self, model: Shared | None, hot: list[bytes], hot_n: np.ndarray, suffix_n: np.ndarray, suffix_v: np.ndarray, n: int, v: int, ends: int):
        self.model, self.hot, self.hot_n, self.n, self.v, self.ends = model, hot, hot_n, n, v, ends
        self.rest = np.log10(suffix_n + suffix_v + 1)  # of each class of last letters: its words, and one for the unknown


def _score(docs: pd.DataFrame, known: pd.DataFrame, shared, buckets: int) -> pd.DataFrame:
    s: Scorer = shared.value
    names = ["_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if not len(docs):
        return pd.DataFrame(columns=names)
    c = ChunkWords(docs["_text"].tolist(), s.hot, buckets)
    known = known.sort_values("bucket")
    sent = np.frombuffer(b"".join(known["n"]), np.int64)
    if len(sent) != len(c.order):
        raise RuntimeError("the documents of a chunk changed between two readings of the input")
    n = np.concatenate((s.hot_n, np.empty(len(c.order), np.int64)))
    n[c.hot + c.order] = sent
    ends = np.cumsum(c.size + 1) - 1
    word = np.ones(len(c.tokens) + len(ends), bool)
    word[ends] = False
    count = np.full(len(word), s.ends, np.int64)
    count[word] = n.take(c.tokens)
    begin = ends - c.size
    of_count = np.log10(np.arange(1, 1025))
    logs = np.where(count < 1024, of_count.take(np.minimum(count, 1023)), np.log10(count + 1.0))
    score = base = logs - np.log10(s.n + s.v + 1)
    if s.model is not None:
        v = s.model.v
        units = np.fromiter(map(v.unit, c.words), np.int32, len(c.words))
        w, a, b = v.sequence(units.take(c.tokens), c.size)
        score = s.model.log_probabilities(w, a, b) / np.log(10)
        suffixes = v.rare.take(w)
        rare = np.flatnonzero(suffixes >= 0)
        score[rare] += logs[rare] - s.rest.take(suffixes[rare])
    return pd.DataFrame({"_id": docs["_id"], "n_tokens": c.size + 1, "n_known": np.add.reduceat((count > 0).astype(np.int64), begin), "train_tokens": s.n, "base_score": np.add.reduceat(base, begin), "score": np.add.reduceat(score, begin)})[names]


def _first_texts(base: DataFrame, size: int) -> list[str]:
    """Training texts of about FIRST_BYTES, by a hash of id and text, each text once and in order of the hash."""
    share = max(1, round(min(1.0, FIRST_BYTES / max(1, size)) * (1 << 40)))
    rows = base.where(F.col("_train") & (F.octet_length("_text") <= FIRST_BYTES // 16)).select(F.xxhash64("_id", "_text").alias("h"), F.col("_text").alias("t"))
    rows = rows.where(F.pmod("h", F.lit(1 << 40)) < share).groupBy("h").agg(F.first("t").alias("t"))
    so_far = rows.selectExpr("h", "t", "sum(octet_length(t)) over (order by h) as upto")
    return [r["t"] for r in so_far.where(F.col("upto") <= 4 * FIRST_BYTES).orderBy("h").select("t").collect()]


def fit_lbl(base: DataFrame, size: int, rows: int, words: DataFrame, hot: list[bytes], first: list[str], most_words: int) -> Scorer:
    """The scorer for the counts of ``words`` (from _merge_words) and the hot words, with the network trained on all training texts.

    The driver trains first on ``first``; from there each task trains on its own rows and the networks are averaged by
    tokens, in two levels of groups.
    """
    spark = base.sparkSession
    hot_n, words = np.zeros(len(hot), np.int64), dict(words)
    for r in words["hot"].groupBy("at").agg(F.sum("n").alias("n")).collect():
        hot_n[r["at"]] = r["n"]
    suffix_n, suffix_v = np.zeros(SUFFIXES, np.int64), np.zeros(SUFFIXES, np.int64)
    for r in words["rest"].select(F.explode("sums").alias("s")).groupBy("s.c").agg(F.sum("s.n").alias("n"), F.sum("s.v").alias("v")).collect():
        suffix_n[r["c"]], suffix_v[r["c"]] = r["n"], r["v"]
    for w, x in zip(hot, hot_n.tolist()):
        suffix_n[suffix(w)] += x
        suffix_v[suffix(w)] += x > 0
    n, v = int(suffix_n.sum()) + rows, int(suffix_v.sum()) + (rows > 0)
    if not rows:
        return Scorer(None, hot, hot_n, suffix_n, suffix_v, n, v, rows)
    found = words["rest"].select(F.explode("top").alias("t")).select(F.col("t.w").alias("w"), F.col("t.n").alias("n")).orderBy(F.desc("n"), "w").limit(most_words).collect()
    top = [(bytes(r["w"]), r["n"]) for r in found] + [(w, x) for w, x in zip(hot, hot_n.tolist()) if x > 1]
    top = sorted(top, key=lambda x: (-x[1], x[0]))[:most_words]
    for w, x in top:
        suffix_n[suffix(w)] -= x
        suffix_v[suffix(w)] -= 1
    model = LogBilinear(Vocabulary(top, suffix_n, rows))
    known = Units(model.v)
    units = [np.fromiter(map(known.__getitem__, w), np.int32, len(w)) for w in map(split, first)]
    for epoch in range(2):
        if units:
            model.train(*model.v.sequence(np.concatenate(units), np.array([len(u) for u in units])), seed=epoch)
    shared = spark.sparkContext.broadcast(Shared(model))
    texts = base.where("_train").select("_text")
    # A task's text outweighs its parameters, else these would be most of what moves.
    at_most = max(1, size // (16 * len(model.pack()) * 4))
    if texts.rdd.getNumPartitions() > max(at_most, 8 * spark.sparkContext.defaultParallelism):
        texts = texts.coalesce(max(at_most, 8 * spark.sparkContext.defaultParallelism))
    kind = "part int, task int, n double, flat binary"
    trained = texts.mapInPandas(partial(_train, shared=shared), kind)
    trained = trained.groupBy("part", (F.col("task") / TASKS_MERGED).cast("int")).applyInPandas(_merge, kind)
    trained = sorted(trained.groupBy("part").applyInPandas(_merge, kind).collect(), key=lambda r: r["part"])
    if trained:
        model.unpack(np.concatenate([np.frombuffer(r["flat"], np.float32) for r in trained]))
    return Scorer(Shared(model), hot, hot_n, suffix_n, suffix_v, n, v, rows)


def lbl_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", most_words: int | None = None) -> DataFrame:
    """Learn from the rows where ``train`` holds and score all whole texts of ``docs``.

    Returns a row for each input row: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (log10, by
    counts alone) and ``score`` (log10, by the network). ``most_words`` sets the words with a unit of their own; by default
    their number grows with the cube root of the training text.

    Null and empty texts are the end token alone; a null ``train`` is false; repeated rows and null ids are learned from
    and scored like any other; if nothing was learned the score is the base score; an empty table gives no rows;
    other columns are ignored. Rows equal in id and text share a chunk. ``docs`` must give the same rows each time it is read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), F.coalesce(train, F.lit(False)).alias("_train"))
    length = F.coalesce(F.octet_length("_text"), F.lit(0))
    size, learned, rows = (x or 0 for x in base.agg(F.sum(length), F.sum(F.when(F.col("_train"), length)), F.count_if("_train")).first())
    if most_words is None:
        most_words = round(WORDS_BY_ROOT * learned ** (1 / 3))
    first = _first_texts(base, learned) if rows else []
    counts = Index()
    n = np.bincount(np.fromiter((counts[w] for t in first for w in split(t)), np.int64), minlength=1)
    names = list(counts)
    hot = sorted(names[i] for i in sorted(np.flatnonzero(n > 1).tolist(), key=lambda i: (-n[i], names[i]))[:HOT])
    chunks, buckets = pieces(size, CHUNK_BYTES, spark, 512 << 10), pieces(size, BUCKET_BYTES, spark, 2 << 20)
    dealt = base.withColumn("_chunk", F.pmod(F.xxhash64("_id", F.octet_length("_text")), F.lit(chunks)).cast("int"))
    sent = dealt.groupBy("_chunk").applyInPandas(partial(_send, hot=spark.sparkContext.broadcast(hot), buckets=buckets), "bucket int, chunk int, words binary, counts binary")
    sent = materialise(sent)
    # At least so often that no more than 64 times as many words as wanted come up, by the pigeonhole principle.
    least = max(2, learned // (7 * 64 * max(1, most_words)))
    kind = "chunk int, bucket int, n binary, sums array<struct<c:int,n:long,v:long>>, top array<struct<w:binary,n:long>>"
    answers = materialise(sent.where("bucket >= 0").groupBy("bucket").applyInPandas(partial(_merge_words, least=least), kind))
    words = {"hot": sent.where("bucket < 0").select("bucket", "counts").mapInPandas(_sum_hot, "at long, n long"), "rest": answers}
    shared = spark.sparkContext.broadcast(fit_lbl(base, learned, rows, words, hot, first, most_words))
    known = answers.select(F.col("chunk").alias("_chunk"), "bucket", "n")
    score = partial(_score, shared=shared, buckets=buckets)
    out = dealt.groupBy("_chunk").cogroup(known.groupBy("_chunk")).applyInPandas(score, "_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("_id", "doc_id")


def op8_lbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return lbl_scores(docs, ~held_out("doc_id", 7)).withColumn("held_out", held_out("doc_id", 7))

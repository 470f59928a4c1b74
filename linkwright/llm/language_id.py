"""Language identification of words by a linear-chain conditional random field, and of documents by their words."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwright.llm.common import bounded_batches, documents

WORD = re.compile(r"[^\W\d_]+")
#: The classifier is fitted on the whole texts of at most this many different rows of each language.
FIT_DOCS = 64
DIMENSIONS = 1 << 17
#: Letters of the words whose features are made at once; a longer word is alone.
CHUNK = 100_000
LEXICON = 300
EPOCHS = 60


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return WORD.findall(text.lower()) if text else []


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature): hashed features of all letters of each word. Prefixes and suffixes of 1 to 4 letters, bigrams and
    trigrams with word ends, the whole word. Words stand one after the other, so none is too long."""
    import xxhash

    n = len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    begin = np.cumsum(size + 2) - size - 2
    at = np.arange(n)
    owner = np.repeat(at, size + 2)
    u = np.ones(int(size.sum()) + 2 * n, dtype=np.uint64)
    u[begin + size + 1] = 2
    inner = np.ones(len(u), dtype=bool)
    inner[begin] = inner[begin + size + 1] = False
    u[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

    def put(h: np.ndarray, tag: int) -> np.ndarray:
        h = (h + np.uint64(tag)) * a
        h ^= h >> np.uint64(31)
        return ((h * b) >> np.uint64(64 - 17)).astype(np.int32)

    rows, out = [], []
    two = u[:-1] * a + u[1:]
    within = owner[1:] == owner[:-1]
    rows.append(owner[:-1][within])
    out.append(put(two[within], 2))
    within = owner[2:] == owner[:-2]
    rows.append(owner[:-2][within])
    out.append(put((two[:-1] * b + u[2:])[within], 3))
    head, tail = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for k in range(1, 5):
        ok = size >= k
        head[ok] = head[ok] * a + u[(begin + k)[ok]]
        tail[ok] = tail[ok] * b + u[(begin + size + 1 - k)[ok]]
        rows += [at[ok], at[ok]]
        out += [put(head[ok], 10 + k), put(tail[ok], 20 + k)]
    rows.append(at)
    out.append(put(np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64), 30))
    return np.concatenate(rows), np.concatenate(out)


def _chunks(words: list[str]):
    """(place of the first, words): runs of words with few enough letters."""
    lo = total = 0
    for i, w in enumerate(words):
        if total and total + len(w) > CHUNK:
            yield lo, words[lo:i]
            lo, total = i, 0
        total += len(w)
    if lo < len(words):
        yield lo, words[lo:]


def _chain(score: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Forward-backward over sequences of descending ``lengths``, packed by time: marginals, scaled forward and
    backward values, and the ranges of each time. ``score``: packed emission scores."""
    longest = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
    ends = np.cumsum(alive)
    spans = list(zip((ends - alive).tolist(), ends.tolist(), strict=True))
    p = np.exp(score - score.max(axis=1, keepdims=True))
    m = np.exp(trans)
    f, b = np.empty_like(p), np.ones_like(p)
    for t, (lo, hi) in enumerate(spans):
        x = p[lo:hi] if t == 0 else (f[spans[t - 1][0] : spans[t - 1][0] + hi - lo] @ m) * p[lo:hi]
        f[lo:hi] = x / x.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        lo, (lo2, hi2) = spans[t][0], spans[t + 1]
        x = (b[lo2:hi2] * p[lo2:hi2]) @ m.T
        b[lo : lo + hi2 - lo2] = x / x.sum(axis=1, keepdims=True)
    g = f * b
    g /= g.sum(axis=1, keepdims=True)
    return g, f, b * p, spans


class WordTagger:
    """Labels words of mixed-language text with marginals of a linear-chain CRF."""

    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray, lexicon: dict[str, int]):
        self.labels, self.weights, self.trans, self.lexicon = labels, weights, trans, lexicon
        self.columns = np.ascontiguousarray(weights.T)
        self.rows: dict[str, int] = {}
        self.scores = np.empty((0, len(labels)), dtype=np.float32)

    def _emission(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.labels)), dtype=np.float32)
        for lo, part in _chunks(words):
            row, index = features(part)
            for k, w in enumerate(self.columns):
                out[lo : lo + len(part), k] = np.bincount(row, w[index], len(part))
        known = [(i, DIMENSIONS + 1 + self.lexicon[w]) for i, w in enumerate(words) if w in self.lexicon]
        if known:
            i, lex = np.array(known).T
            out[i] += self.weights[lex]
        return out

    @classmethod
    def fit(cls, samples: list[tuple[str, list[str]]], epochs: int = EPOCHS, seed: int = 5) -> WordTagger:
        """samples: (language, words). Sequences are windows of 20 words, half of them joined with one of another
        document, so that switches are seen; penalised likelihood by Adagrad on all of them."""
        samples = [(lang, words) for lang, words in samples if words]
        labels = sorted({lang for lang, _ in samples})
        if not labels:
            return cls([], np.zeros((DIMENSIONS + 1, 0), np.float32), np.zeros((0, 0)), {})
        code = {lang: i for i, lang in enumerate(labels)}
        rng = np.random.default_rng(seed)
        counts: list[dict[str, int]] = [{} for _ in labels]
        windows = []
        for lang, words in samples:
            for w in words:
                counts[code[lang]][w] = counts[code[lang]].get(w, 0) + 1
            windows += [(code[lang], words[i : i + 20]) for i in range(0, len(words), 20)]
        lexicon: dict[str, int] = {}
        for k, c in enumerate(counts):
            for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
                if n > 2 * max((o.get(w, 0) for j, o in enumerate(counts) if j != k), default=0):
                    lexicon[w] = k
        windows = [windows[i] for i in rng.permutation(len(windows))]
        half = len(windows) // 3
        seqs = [[a, b] for a, b in zip(windows[:half], windows[half : 2 * half], strict=True)] + [[a] for a in windows[2 * half :]]
        seqs.sort(key=lambda s: -sum(len(w) for _, w in s))
        tokens = [[(c, w) for c, ws in s for w in ws] for s in seqs]
        lengths = np.array([len(t) for t in tokens])
        packed = [t[k] for k in range(int(lengths.max(initial=0))) for t in tokens if k < len(t)]
        vocab = {w: i for i, w in enumerate(dict.fromkeys(w for _, w in packed))}
        y, word = np.array([c for c, _ in packed]), np.array([vocab[w] for _, w in packed])
        size = DIMENSIONS + 1 + len(labels)
        parts = [(lo + row, index) for lo, ws in _chunks(list(vocab)) for row, index in [features(ws)]]
        known = np.array([(i, DIMENSIONS + 1 + lexicon[w]) for w, i in vocab.items() if w in lexicon], dtype=np.int64).reshape(-1, 2)
        owner = np.concatenate([*(p[0] for p in parts), known[:, 0]])
        index, place = np.unique(np.concatenate([*(p[1] for p in parts), known[:, 1]]), return_inverse=True)
        n_labels = len(labels)
        w, t = np.zeros((len(index), n_labels)), np.zeros((n_labels, n_labels))
        gw, gt = np.full_like(w, 1e-2), np.full_like(t, 1e-2)
        gold = np.zeros((len(y), n_labels))
        gold[np.arange(len(y)), y] = 1
        for _ in range(epochs):
            score = np.stack([np.bincount(owner, w[place, k], len(vocab)) for k in range(n_labels)], axis=1)
            marginal, f, back, spans = _chain(score[word], lengths, t)
            diff = np.stack([np.bincount(word, (gold - marginal)[:, k], len(vocab)) for k in range(n_labels)], axis=1)
            grad = np.stack([np.bincount(place, diff[owner, k], len(index)) for k in range(n_labels)], axis=1) - 0.02 * w
            m, gt_now = np.exp(t), -0.02 * t
            for (lo, _), (lo2, hi2) in zip(spans, spans[1:], strict=False):
                pair = f[lo : lo + hi2 - lo2, :, None] * m * back[lo2:hi2, None, :]
                pair /= pair.sum(axis=(1, 2), keepdims=True)
                gt_now += gold[lo : lo + hi2 - lo2].T @ gold[lo2:hi2] - pair.sum(axis=0)
            gw += grad**2
            gt += gt_now**2
            w += 0.3 * grad / np.sqrt(gw)
            t += 0.3 * gt_now / np.sqrt(gt)
        weights = np.zeros((size, n_labels), dtype=np.float32)
        weights[index] = w
        return cls(labels, weights, t, lexicon)

    def _ids(self, docs: list[list[str]]) -> list[np.ndarray]:
        if len(self.rows) > 400_000:
            self.rows, self.scores = {}, self.scores[:0]
        rows = self.rows
        new = list({w for words in docs for w in words if w not in rows})
        if new:
            base = len(rows)
            rows.update(zip(new, range(base, base + len(new)), strict=True))
            if len(rows) > len(self.scores):
                self.scores = np.concatenate([self.scores[:base], np.zeros((len(rows) - base + len(rows) // 2, len(self.labels)), np.float32)])
            self.scores[base : len(rows)] = self._emission(new)
        get = rows.__getitem__
        return [np.fromiter(map(get, words), np.int64, len(words)) for words in docs]

    def marginals(self, docs: list[list[str]]) -> list[np.ndarray]:
        """For each list of words, the labels' probabilities of each word."""
        out: list = [np.zeros((0, len(self.labels)))] * len(docs)
        order = sorted((i for i, d in enumerate(docs) if d), key=lambda i: -len(docs[i]))
        for group in self._groups(order, docs):
            g, where = self._run([docs[i] for i in group])
            for k, i in enumerate(group):
                out[i] = g[where == k]
        return out

    def _groups(self, order: list[int], docs: list[list[str]], most: int = 200_000):
        group, total = [], 0
        for i in order:
            if group and total + len(docs[i]) > most:
                yield group
                group, total = [], 0
            group.append(i)
            total += len(docs[i])
        if group:
            yield group

    def _run(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids(docs)
        lengths = np.array([len(i) for i in ids])
        when = np.concatenate([np.arange(n) for n in lengths])
        who = np.repeat(np.arange(len(ids)), lengths)
        order = np.lexsort((who, when))
        who = who[order]
        g, *_ = _chain(self.scores[np.concatenate(ids)[order]], lengths, self.trans.astype(np.float32))
        return g, who

    def shares(self, docs: list[list[str]]) -> np.ndarray:
        """Mean probability of each label over the words of each document; zeros where it has none."""
        out = np.zeros((len(docs), len(self.labels)))
        order = sorted((i for i, d in enumerate(docs) if d), key=lambda i: -len(docs[i]))
        for group in self._groups(order, docs):
            g, who = self._run([docs[i] for i in group])
            for k in range(len(self.labels)):
                out[group, k] = np.bincount(who, g[:, k], len(group))
        return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-12)


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> WordTagger:
    """Learns from the whole texts of at most ``fit_docs`` rows of each language, whatever the input's size: rows with a
    language that aren't held out, those of the least seeded hashes of id and text. Languages are counted over all
    rows; equal rows are one, however many they are, so that none can swell the sample."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select(F.xxhash64(F.lit(11), "doc_id", "text").alias("h"), "lang", "text")
    counts = {r[0]: r[1] for r in known.groupBy("lang").agg(F.approx_count_distinct("h")).collect()}
    if not counts:
        return WordTagger.fit([])
    # A hash's bound leaves about four times the rows that are taken; only these are ranked.
    pick = F.lit(False)
    for lang, n in counts.items():
        pick = pick | ((F.col("lang") == lang) & (F.pmod("h", F.lit(1 << 30)) < int(min(1.0, 4 * fit_docs / n) * (1 << 30))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))
    rows = known.where(pick).groupBy("lang", "h").agg(F.first("text").alias("text")).withColumn("rank", rank).where(F.col("rank") <= fit_docs).collect()
    rows.sort(key=lambda r: (r["lang"], r["rank"]))
    return WordTagger.fit([(r["lang"], words_of(r["text"])) for r in rows])


def predict(docs: DataFrame, tagger: WordTagger) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score``: the label with most of the words' probability and its share.

    Only ``text`` is looked at. Null texts, texts without a letter, and all texts where nothing could be learned are
    ``und`` with score 0. Of equal shares the first language by name is taken. Repeated rows stay; columns of these names in the input are replaced.
    """
    bounded_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    labels, weights, trans, lexicon = tagger.labels, tagger.weights, tagger.trans, tagger.lexicon
    model = docs.sparkSession.sparkContext.broadcast((labels, weights, trans, lexicon))
    at = keep.index("text")

    def run(batches):
        own = WordTagger(*model.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 750):
                part = batch.slice(lo, 750)
                words = [words_of(t) for t in part.column(at).to_pylist()]
                if own.labels:
                    share = own.shares(words)
                    best = share.argmax(axis=1)
                    lang = [own.labels[k] if w else "und" for k, w in zip(best, words, strict=True)]
                    score = [float(min(1.0, max(0.0, s))) if w else 0.0 for s, w in zip(share.max(axis=1), words, strict=True)]
                else:
                    lang, score = ["und"] * len(words), [0.0] * len(words)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang), pa.array(score, pa.float64())], names=[*keep, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, f"{kinds}, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), fit(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")

"""Token counts without ids: Viterbi over a unigram vocabulary whose matches an Aho-Corasick automaton enumerates."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import documents, tokenizer_path

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
LONGEST_CACHED = 64


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) from a sentencepiece file; the score is the log of 1 / (rank + 1), as Zipf's rule has it for pieces in rank order."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    own = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return [(p, -math.log(rank + 1.0)) for rank, p in enumerate(own, 1)]


class UnigramCounter:
    """Pieces in the best segmentation, by the rules of the ``tokenizers`` library's Unigram model.

    Words begin with the space mark (Metaspace, prepended always). At each end the earliest start wins a tie of
    scores; a character that is no piece is unknown at ten below the least score; neighbouring unknowns are one piece.
    """

    def __init__(self, pieces: list[tuple[str, float]], entries: int = 300_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for p, score in pieces:
            self.automaton.add_word(p, (len(p), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.entries = entries
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def pieces_in(self, word: str) -> int:
        """Pieces of one word, its space mark included: best score and piece count carried over ends."""
        n = len(word)
        score, count, odd = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done, single, has = 0, False, False  # the end being filled, whether one character matches there, whether it has a path

        def close(end: int) -> None:
            if not single:
                s = score[end - 1] + self.unknown
                if not has or s > score[end]:
                    score[end], count[end], odd[end] = s, count[end - 1] + (not odd[end - 1]), True

        for at, (size, s) in self.automaton.iter(word):
            end = at + 1
            if end != done:
                if done:
                    close(done)
                for e in range(done + 1, end):
                    single = has = False
                    close(e)
                done, single, has = end, False, False
            s += score[end - size]
            if size == 1:
                single = True
            if not has or s > score[end]:
                score[end], count[end], odd[end], has = s, count[end - size] + 1, False, True
        if done:
            close(done)
        for e in range(done + 1, n + 1):
            single = has = False
            close(e)
        return count[n]

    def words(self, text: str) -> list[str]:
        if SPACE in text:
            text = text.replace(SPACE, " ")
        words = text.split(" ")
        return words[1:] if text.startswith(" ") else words

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        words = self.words(text)
        young = self.young
        try:
            return sum(map(young.__getitem__, words))
        except KeyError:
            pass
        if len(young) > self.entries:
            self.old, self.young = young, {}
            young = self.young
        old, total = self.old, 0
        for w in words:
            n = young.get(w)
            if n is None:
                n = old.get(w)
                if n is None:
                    n = self.pieces_in(SPACE + w)
                if len(w) <= LONGEST_CACHED:
                    young[w] = n
            total += n
        return total


_COUNTERS: dict[str, UnigramCounter] = {}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of each row's whole text; null and empty texts have none. One pass, no shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        if path not in _COUNTERS:
            _COUNTERS[path] = UnigramCounter(vocabulary(path))
        count = _COUNTERS[path].count
        for batch in batches:
            n = [count(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], schema=schema)

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), size.alias("n_bytes"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))

"""Interleaved document sequences: pages parse to ordered text and media references, which a digest join resolves.

Media are stored as 8-bit unsigned PCM in WAV form (mono, 8000 samples a second), one stored form per digest of the
samples. Positions and captions stay with their reference; what the join adds comes from the stored bytes.
"""

from __future__ import annotations

import hashlib
import html
import re
import struct
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import checkpoint, documents, fresh_path

BLOCK = 64
WAV = struct.Struct("<4sI4s4sIHHIIHH4sI")
RATE = 8000
SILENT = ("script", "style", "noscript", "template", "title")
MEDIA = ("img", "audio", "video", "source")
PARAGRAPHS = ("p", "div", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "br", "tr", "table", "section", "article", "nav", "figure", "figcaption", "blockquote", "pre", "header", "footer", "main", "aside", "body")


def pad(raw: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


def to_media(samples: bytes) -> bytes:
    """Samples as a WAV file; an odd count would get the format's pad byte (ours are multiples of 64)."""
    n = len(samples)
    return WAV.pack(b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n) + samples


def from_media(media: bytes) -> bytes:
    head = WAV.unpack_from(media)
    if head[0] != b"RIFF" or head[2] != b"WAVE" or head[10] != 8 or head[12] != len(media) - WAV.size:
        raise ValueError("not a stored payload")
    return media[WAV.size :]


def feature(samples: bytes) -> str:
    """Mean, RMS about 128, share of crossings of 128, and a spectral slope (mean absolute step), of all samples."""
    x = np.frombuffer(samples, dtype=np.uint8)
    s = x.astype(np.float32) - 128
    up = x >= 128
    crossings = np.count_nonzero(up[1:] != up[:-1]) / max(1, len(x) - 1)
    step = float(np.abs(np.diff(s)).mean(dtype=np.float64)) if len(x) > 1 else 0.0
    return f"mean={s.mean(dtype=np.float64):.4f};rms={float(np.sqrt((s * s).mean(dtype=np.float64))):.4f};cross={crossings:.6f};step={step:.4f}"


class Figure:
    """An open figure: its media, the elements that hold its caption's text, and whether a caption was ended by a tag."""

    def __init__(self):
        self.media: list[dict] = []
        self.caption: list[dict] = []
        self.ended = False

    def close(self, outer: Figure | None) -> None:
        """Gives the caption to the media. A caption without media stays text; media without a caption go to the outer
        figure; of a caption that nothing ended, the first block counts and the rest stays text."""
        if not self.caption:
            if outer:
                outer.media += self.media
        elif self.media:
            own = self.caption if self.ended else self.caption[:1]
            text = " ".join(e["text"] for e in own)
            for e in self.media:
                e["caption"] = text
            for e in own:
                e["kind"] = None


class PageParser(HTMLParser):
    """Ordered elements of a page. Text between media is one element for each block; a caption is that of the innermost
    figure that has one, before or after its media, or else the reference's alt or title. Text is left out only in
    ``SILENT`` elements; a missing ``</head>`` hides nothing, and of elements that aren't void only empty silent ones may
    end in ``/>``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.buffer: list[str] = []
        self.silent: list[str] = []
        self.figures: list[Figure] = []
        self.captioned: Figure | None = None

    def flush(self) -> None:
        if text := " ".join("".join(self.buffer).split()):
            self.out.append({"kind": "text", "text": text, "ref": None, "caption": None, "n_bytes": None})
            if self.captioned:
                self.captioned.caption.append(self.out[-1])
        self.buffer = []

    def end_caption(self, ended: bool) -> None:
        if self.captioned:
            self.flush()
            self.captioned.ended |= ended
            self.captioned = None

    def handle_starttag(self, tag, attrs):
        if self.silent and self.silent[-1] == "title":
            self.silent.pop()  # it holds no tags: it wasn't closed
        if tag in SILENT:
            self.silent.append(tag)
        if self.silent:
            return
        if tag in PARAGRAPHS:
            self.flush()
        if tag == "figure":
            self.end_caption(False)
            self.figures.append(Figure())
        elif tag == "figcaption" and self.figures:
            self.end_caption(True)
            self.captioned = self.figures[-1]
        elif tag in MEDIA:
            a = dict(attrs)
            if a.get("src"):
                self.flush()
                n = a.get("data-bytes")
                n = int(n) if n and re.fullmatch("[0-9]{1,18}", n) else None
                self.out.append({"kind": "media", "text": None, "ref": a["src"], "caption": a.get("alt") or a.get("title") or "", "n_bytes": n})
                if self.figures:
                    self.figures[-1].media.append(self.out[-1])

    def handle_startendtag(self, tag, attrs):
        if tag not in SILENT:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in self.silent:
            while self.silent.pop() != tag:
                pass
            return
        if self.silent and tag != "body":
            return
        self.silent.clear()
        if tag == "figcaption":
            self.end_caption(True)
        if tag == "figure" and self.figures:
            self.end_caption(True)
            self.flush()
            figure = self.figures.pop()
            figure.close(self.figures[-1] if self.figures else None)
        if tag in PARAGRAPHS:
            self.flush()

    def handle_data(self, data):
        if not self.silent:
            self.buffer.append(data)

    def elements(self) -> list[dict]:
        self.close()
        self.end_caption(False)
        self.flush()
        while self.figures:
            self.figures.pop().close(self.figures[-1] if self.figures else None)
        return [e for e in self.out if e["kind"]]


def parse_page(page: str | None) -> list[dict]:
    """Elements of a page in order, their position counted from 0; a null or empty page has none."""
    if not page:
        return []
    p = PageParser()
    p.feed(page)
    return [{"pos": i, **e} for i, e in enumerate(p.elements())]


ELEMENT = pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string()), ("n_bytes", pa.int64())])
ELEMENT_DDL = "array<struct<pos int, kind string, text string, ref string, caption string, n_bytes long>>"


def sequences(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, elements): each page's interleaved sequence, in one pass without a shuffle."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([parse_page(t) for t in b.column(1).to_pylist()], pa.list_(ELEMENT))], names=[id_col, "elements"])

    return pages.select(F.col(id_col).cast("long").alias(id_col), F.col(html_col).cast("string").alias(html_col)).mapInArrow(run, f"{id_col} long, elements {ELEMENT_DDL}")


def read_media(store: DataFrame) -> DataFrame:
    """(digest, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature), one row per digest, from stored bytes."""
    names = ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    schema = pa.schema([(n, pa.int64() if n in ("payload_bytes", "tail_crc32", "media_bytes") else pa.string()) for n in names])

    def run(batches):
        for b in batches:
            rows = []
            for digest, media in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                media = media.as_py()
                raw = from_media(media)
                rows.append((digest, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), feature(raw)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    kinds = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    found = store.where(F.col("media").isNotNull()).select("digest", "media").mapInArrow(run, kinds)
    # Copies that several tasks stored have equal values: any of them serves. Stored, so that the join with references,
    # of which many may share a digest, stands alone and can be split.
    return checkpoint(found.groupBy("digest").agg(*[F.first(n).alias(n) for n in names[1:]]))


def resolve(seq: DataFrame, payloads: DataFrame, id_col: str) -> DataFrame:
    """One row per media element with its position and caption and its payload's columns, which are null where the
    reference (``sha256:<digest>``) isn't stored. A digest that many references share is one row of ``payloads``."""
    refs = seq.select(id_col, F.explode("elements").alias("e")).where("e.kind = 'media'")
    refs = refs.select(id_col, F.col("e.pos").alias("pos"), F.col("e.caption").alias("caption"), F.col("e.n_bytes").alias("n_bytes"), F.regexp_extract("e.ref", "^sha256:([0-9a-f]{64})$", 1).alias("digest"))
    return refs.join(payloads, "digest", "left")


def store_documents(docs: DataFrame, path: str) -> None:
    """Stores each text's padded UTF-8 as media and writes the page that refers to it: (doc_id, page, digest, media).

    A task stores a digest once; null texts are empty, an empty text is 64 zero bytes.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("page", pa.string()), ("digest", pa.string()), ("media", pa.binary())])

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = []
                part = batch.slice(lo, 500)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    raw = (text or "").encode()
                    payload = pad(raw)
                    h = hashlib.sha256(payload)
                    digest, new = h.hexdigest(), h.digest() not in seen
                    seen.add(h.digest())
                    caption = html.escape(f"text of document {doc_id}")
                    page = f'<html><body><p>Document {doc_id}.</p><figure><img src="sha256:{digest}" data-bytes="{len(raw)}"><figcaption>{caption}</figcaption></figure></body></html>'
                    rows.append((doc_id, page, digest, to_media(payload) if new else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, page string, digest string, media binary").write.mode("overwrite").option("compression", "zstd").parquet(path)


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "media")
    store_documents(documents(spark, sf_dir), path)
    store = spark.read.parquet(path)
    found = resolve(sequences(store, "doc_id", "page"), read_media(store), "doc_id")
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pos", "caption")

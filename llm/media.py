"""Media columns: interleaved sequences of text and media references, resolved by digest.

store() keeps each payload losslessly as 8-bit samples in a WAV column of a
table in the shared folder; sequences() turns HTML into ordered text and reference
structs, one array per page, and items() makes rows of them; resolve() joins
references to what was read back from the store, by digest. Only references and
features travel through the join, never payloads or texts.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm._common import bounded_batches, hot_join, materialise
from llm._text import slices

UNIT = 64
#: Described payloads that may be broadcast in one join (some 300 bytes each).
BROADCAST_PAYLOADS = 50_000
_RATE = 8000
_HEAD = struct.Struct("<4sI4s4sIHHIIHH4sI")


def encode_wav(payload: bytes) -> bytes:
    """Bytes as the samples of an 8-bit mono PCM file."""
    return _HEAD.pack(b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, _RATE, _RATE, 1, 8, b"data", len(payload)) + payload


def decode_wav(stored: bytes) -> bytes:
    """The samples of such a file, found by walking its chunks."""
    at = 12
    while at + 8 <= len(stored):
        name, size = struct.unpack_from("<4sI", stored, at)
        if name == b"data":
            return stored[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def feature(payload: bytes) -> str:
    """Mean, spread, sign changes and a four-bin histogram of the samples, as integers: equal payloads, equal strings."""
    x = np.frombuffer(payload, np.uint8)
    n, total, squares = len(x), int(x.sum(dtype=np.int64)), int((x.astype(np.int64) ** 2).sum())
    changes = int(np.count_nonzero(np.diff(x >= 128)))
    bins = np.bincount(x >> 6, minlength=4)[:4]
    return f"mean={total * 1000 // n};var={(squares * n - total * total) * 1000 // (n * n)};turns={changes};hist={','.join(map(str, bins))}"


def store(documents: DataFrame) -> DataFrame:
    """digest, n_bytes, media per row, written to the shared folder. Null texts count as empty."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches):
            raw = [("" if t is None else t).encode("utf-8", "surrogatepass") for t in b["text"]]
            yield pd.DataFrame({
                "digest": [hashlib.sha256(r).hexdigest() for r in raw],
                "n_bytes": [len(r) for r in raw],
                "media": [encode_wav(r + bytes(-len(r) % UNIT if r else UNIT)) for r in raw],
            })

    bounded_batches(documents.sparkSession)
    return materialise(documents.select("text").mapInPandas(encode, "digest string, n_bytes long, media binary"), "media-store")


def describe(stored: DataFrame) -> DataFrame:
    """One row per digest, from the stored bytes: digest, copies (rows that have it), n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    Repeated payloads are one row with their number; an empty store gives no rows.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            payloads = [decode_wav(m) for m in b["media"]]
            yield pd.DataFrame({
                "digest": b["digest"], "n_bytes": b["n_bytes"],
                "payload_bytes": [len(p) for p in payloads],
                "payload_sha256": [hashlib.sha256(p).hexdigest() for p in payloads],
                "tail_crc32": [zlib.crc32(p[-UNIT:]) for p in payloads],
                "media_bytes": [len(m) for m in b["media"]],
                "media_sha256": [hashlib.sha256(m).hexdigest() for m in b["media"]],
                "feature": [feature(p) for p in payloads],
            })

    schema = "digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    rest = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    return stored.mapInPandas(read, schema).groupBy("digest").agg(F.count("*").alias("copies"), *[F.min(c).alias(c) for c in rest])


class _Sequence(HTMLParser):
    """Text runs and images in document order; a figure's caption belongs to its images."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.hidden = self.caption_of = 0
        self.caption: list[str] | None = None
        self.figure = None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag == "figure":
            self.figure = len(self.items)
        elif tag == "figcaption":
            self.caption = []
        elif tag in ("img", "audio", "video", "source"):
            of = dict(attrs)
            if of.get("src"):
                self.items.append({"kind": "media", "text": None, "ref": of["src"], "caption": of.get("alt")})

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag == "figcaption" and self.caption is not None:
            said = "".join(self.caption).strip()
            for x in self.items[self.figure or 0 :]:
                if x["kind"] == "media":
                    x["caption"] = said
            self.caption = None
        elif tag == "figure":
            self.figure = None

    def handle_data(self, data):
        if self.hidden:
            return
        if self.caption is not None:
            self.caption.append(data)
        elif data.strip():
            if self.items and self.items[-1]["kind"] == "text":
                self.items[-1]["text"] += data
            else:
                self.items.append({"kind": "text", "text": data, "ref": None, "caption": None})


def sequence(html: str | None) -> list[dict]:
    """The ordered items of one page; null or empty HTML has none, and broken markup is read as far as it goes."""
    p = _Sequence()
    p.feed(html or "")
    p.close()
    return p.items


ITEMS = "array<struct<position:int,kind:string,text:string,ref:string,caption:string>>"


def sequences(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key and items (ordered structs of position, kind (text or media), text, ref, caption) of each page's HTML: a row per row of pages.

    Null and empty HTML have no items; a repeated page has its items again; an empty
    table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            items = [[{"position": i, **x} for i, x in enumerate(sequence(h))] for h in b["html"]]
            yield pd.DataFrame({"_key": b["_key"], "items": items})

    bounded_batches(pages.sparkSession)
    out = pages.select(F.col(key).cast("string").alias("_key"), "html").mapInPandas(run, f"_key string, items {ITEMS}")
    return out.select(F.col("_key").cast(dict(pages.dtypes)[key]).alias(key), "items")


def items(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, position, kind, text, ref, caption: a row per item of each page's HTML."""
    return sequences(pages, key).select(key, F.explode("items").alias("i")).select(key, "i.*")


def resolve(items: DataFrame, described: DataFrame) -> DataFrame:
    """items with what the store has for their digest (`media:<digest>`), null for texts and for references it doesn't have.

    Positions and captions stay as they were. Texts don't go through the join; a
    digest that very many items refer to is broadcast. described is materialised.
    Repeated items stay as often as they are there; null references are texts.
    """
    x = items.withColumn("digest", F.when(F.col("ref").startswith("media:"), F.substring("ref", 7, 64)))
    found = hot_join(x.where("digest IS NOT NULL"), described, ["digest"], "copies", "left", BROADCAST_PAYLOADS).drop("copies")
    return found.unionByName(x.where("digest IS NULL"), allowMissingColumns=True)


def _html(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def articles(documents: DataFrame) -> DataFrame:
    """Each document as HTML: its first line, a figure that refers to the whole text by digest, and the other lines; null counts as empty, a missing id as `-`."""
    text = F.coalesce("text", F.lit(""))
    lead = F.regexp_extract(text, r"^[^\n]*\n?", 0)
    caption = F.concat(F.lit("document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    figure = F.concat(F.lit('<figure><img src="media:'), F.sha2(text, 256), F.lit('"/><figcaption>'), caption, F.lit("</figcaption></figure>"))
    return documents.select("doc_id", F.concat(F.lit("<h1>"), _html(lead), F.lit("</h1>"), figure, F.lit("<p>"), _html(F.substring(text, F.length(lead) + 1, F.length(text))), F.lit("</p>")).alias("html"))


def media_columns(documents: DataFrame) -> DataFrame:
    """A row per row of documents: doc_id, the features of its payload read back from the store, and its place in the document's sequence.

    position counts from 0 among n_items texts and media; texts of white space only
    are no items. Null and empty texts have a payload of one unit of zeros at
    position 0. Repeated rows and equal texts have equal values, rows without an id
    too. An empty table gives no rows; other columns are ignored.
    """
    kept = materialise(describe(store(documents)), "media-features")
    media = sequences(articles(documents), "doc_id").select("doc_id", F.size("items").alias("n_items"), F.explode(F.filter("items", lambda i: i["kind"] == "media")).alias("i"))
    return resolve(media.select("doc_id", "n_items", "i.*"), kept).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "n_items", "caption"
    )

"""Operator 5: byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks of some hundred characters that overlap. Each chunk is pre-tokenised by itself, from wherever it
starts. Two neighbours are stitched where their boundaries resynchronise: at the first boundary in the overlap that both
found and that is certain. A boundary is certain if the two characters around it make it one whatever comes before and
after, for instance a letter and a digit, a full stop and a letter, or anything and a space after it; so it is one of the
whole text. The matches between the stitches are encoded one by one and their ids concatenated. Neighbours without such a
boundary stay in one piece, which is matched again. Where a text has characters that engines may class differently, what
lies between its stitches is matched by the library. Texts of more than ``section`` characters are first dealt to several tasks, by sections that
overlap and are stitched in the same way. Decoding concatenates the bytes of the ids.

Nulls, ties, empty input: a null text counts as empty and has no ids; repeated rows give repeated rows; an empty table
gives an empty result; a text of any length is encoded whole, and what a task holds of it is a section, unless nothing but
letters, or nothing but digits, or signs, or spaces fills the overlaps. Input columns named like an output column are
replaced.
"""

from __future__ import annotations

import base64
import itertools
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters by which sections overlap.
SEAM = 1024


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """Each id's bytes. Made once in each Python worker."""
    ranks = ranks_of(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


@lru_cache(maxsize=2)
def encoder(path: str):
    """tiktoken's encoder for the ranks in path. Made once in each Python worker."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(path), special_tokens={})


@lru_cache(maxsize=1)
def splitter():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


class Classes(dict):
    """What the pattern tells apart: L (letter), N (number), S (space) or O (other); empty for characters that Unicode 3.2
    did not have or classed in another way, as later tables of the engines may not agree on them."""

    def __missing__(self, c: str) -> str:
        found = {self._of(c, unicodedata), self._of(c, unicodedata.ucd_3_2_0)}
        self[c] = value = found.pop() if len(found) == 1 else ""
        return value

    @staticmethod
    def _of(c: str, tables) -> str:
        kind = tables.category(c)
        # \x1c to \x1f: space to some engines only
        return "" if kind == "Cn" or "\x1c" <= c <= "\x1f" else "S" if c.isspace() else kind[0] if kind[0] in "LN" else "O"


CLASSES = Classes()


def certain(text: str, at: int) -> bool:
    """Whether a match of the pattern ends between text[at - 1] and text[at], whatever is around them: no match goes on from
    a letter, a number or a sign to a space or another class, but for the letters of 's and the like after an apostrophe."""
    a, b = CLASSES[text[at - 1]], CLASSES[text[at]]
    if not a or not b or a == b or a == "S":
        return False
    return not (a == "O" and b == "L" and text[at - 1] == "'")


def stitches(text: str, chunk: int, overlap: int) -> list[int]:
    """Where the matches of overlapping chunks, each pre-tokenised by itself, are stitched; increasing."""
    out: list[int] = []
    if len(text) <= chunk:
        return out
    step, find, left = chunk - overlap, splitter().finditer, frozenset()
    for start in range(0, len(text) - overlap, step):
        ends = [m.end() for m in find(text, start, start + chunk)]
        last = min(start + overlap, len(text) - 1)
        common = (e for e in ends if start < e <= last and e in left and certain(text, e))
        out.extend(e for e, _ in zip(common, range(1), strict=False))
        left = frozenset(e for e in ends if e > start + step)
    return out


def matches(text: str, chunk: int, overlap: int) -> list[str]:
    """The pattern's matches in a text: those of its chunks, from one stitch to the next. What lies between the stitches
    of neighbours that aren't stitched to each other is matched again as a whole."""
    find = splitter().findall
    if len(text) <= chunk:
        return find(text)
    out: list[str] = []
    since, whole = 0, True
    left, left_ends = [], []
    for start in range(0, len(text) - overlap, chunk - overlap):
        right = find(text, start, start + chunk)
        ends = list(itertools.accumulate(map(len, right), initial=start))[1:]
        if start:
            known = frozenset(left_ends[bisect_right(left_ends, start) :])
            last = min(start + overlap, len(text) - 1)
            cut = next((e for e in ends[: bisect_right(ends, last)] if e in known and certain(text, e)), None)
            if cut is None:
                whole = False
            else:
                out += left[bisect_right(left_ends, since) : bisect_right(left_ends, cut)] if whole else find(text[since:cut])
                since, whole = cut, True
        left, left_ends = right, ends
    return out + (left[bisect_right(left_ends, since) :] if whole else find(text[since:]))


#: Matches whose ids a worker remembers, at most, and their most characters.
REMEMBERED, SHORT = 1 << 17, 32


class Ids(dict):
    """The ids of a match, little-endian unsigned 32-bit; those of short ones are remembered."""

    def __init__(self, bpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, match: str) -> bytes:
        found = self.bpe._encode_single_piece(match)
        ids = pack(f"<{len(found)}I", *found)
        if len(match) <= SHORT and len(self) < REMEMBERED:
            self[match] = ids
        return ids


@lru_cache(maxsize=2)
def remembered(bpe) -> Ids:
    return Ids(bpe)


def sure(text: str) -> bool:
    """Whether all engines class all characters of a text alike. The long s counts as an s in 's to some."""
    return all(map(CLASSES.__getitem__, set(text))) and "\u017f" not in text


def encode_text(bpe, text: str, chunk: int, overlap: int) -> bytes:
    """The ids of a text, little-endian unsigned 32-bit. The matches that the chunks found are encoded each by itself; a
    text with characters that aren't sure is matched again by the library, between the stitches."""
    if sure(text):
        found = matches(text, chunk, overlap)
        if sum(map(len, found)) == len(text):
            return b"".join(map(remembered(bpe).__getitem__, found))
    cuts = [0, *stitches(text, chunk, overlap), len(text)]
    return b"".join(np.asarray(bpe.encode_ordinary(text[a:b]), dtype="<u4").tobytes() for a, b in itertools.pairwise(cuts))


def once_each(do: Callable, values: Iterable) -> list:
    """do(value) of each value, worked out once for neighbours that are equal, as the copies of a text in a mix are."""
    out: list = []
    before: list = []
    for value in values:
        if before != [value]:
            before, found = [value], do(value)
        out.append(found)
    return out


def seam(zone: str) -> int | None:
    """The first certain boundary in the overlap of two sections. It depends on the overlap alone, so both find the same."""
    return next((m.end() for m in splitter().finditer(zone) if m.end() < len(zone) and certain(zone, m.end())), None)


def _encode_sections(docs: DataFrame, path: str, chunk: int, overlap: int, section: int) -> DataFrame:
    """Rows (text, _rest) of long texts as (_rest, ids)."""
    wide = min(SEAM, section // 2)
    last = F.ceil(F.length("text") / section).cast("int") - 1
    cut = docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_last", last).withColumn("_at", F.explode(F.sequence(F.lit(0), last)))
    cut = cut.select("_row", "_at", (F.col("_at") == F.col("_last")).alias("_ends"), F.when(F.col("_at") == 0, F.col("_rest")).alias("_rest"), F.substr("text", F.col("_at") * section + 1, F.lit(section + wide)).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for b in batches:
            glued, open_, ids, texts = [], [], [], []
            for at, ends, text in zip(b["_at"], b["_ends"], b["text"], strict=True):
                first = 0 if at == 0 else seam(text[:wide])
                after = None if ends else seam(text[section : section + wide])
                whole = text[first or 0 : len(text) if ends else section + (after or 0)]
                glued.append(first is None)
                open_.append(not ends and after is None)
                apart = glued[-1] or open_[-1]
                ids.append(b"" if apart else encode_text(bpe, whole, chunk, overlap))
                texts.append(whole if apart else "")
            yield b.drop(columns="_ends").assign(_glued=glued, _open=open_, ids=ids, text=texts)

    fields = [f for f in cut.schema.fields if f.name != "_ends"]
    kinds = (("_glued", T.BooleanType()), ("_open", T.BooleanType()), ("ids", T.BinaryType()))
    encoded = cut.repartition("_row", "_at").mapInPandas(run, T.StructType([*fields, *[T.StructField(n, k) for n, k in kinds]]))
    parts = encoded.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_at", "_glued", "_open", "text", "ids"))).alias("_parts"), F.first("_rest", ignorenulls=True).alias("_rest"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = []
            for parts in b["_parts"]:
                out, held = [], ""
                for p in parts:
                    if p["_glued"] or p["_open"]:
                        held += p["text"]
                        if p["_open"]:
                            continue
                        out.append(encode_text(encoder(path), held, chunk, overlap))
                        held = ""
                    else:
                        out.append(p["ids"])
                ids.append(b"".join(out))
            yield b[["_rest"]].assign(ids=ids)

    flat = parts.select("_rest", "_parts")
    return flat.mapInPandas(join, T.StructType([flat.schema["_rest"], T.StructField("ids", T.BinaryType())]))


def encode(docs: DataFrame, path: str | None = None, chunk: int = 512, overlap: int = 64, section: int = 1 << 18) -> DataFrame:
    """docs (text and any more) with ids in place of text: little-endian unsigned 32-bit integers. ``path``: a file of
    ranks. Texts never move but for the sections of those that have several."""
    path = path or vocabulary_path()
    small_batches(docs.sparkSession)
    docs = docs.drop("ids")
    others = [c for c in docs.columns if c != "text"]
    long = F.coalesce(F.length("text"), F.lit(0)) > section
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != "text"], T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for b in batches:
            yield b.drop(columns="text").assign(ids=once_each(lambda t: encode_text(bpe, t or "", chunk, overlap), b["text"]))

    short = docs.where(~long).mapInPandas(run, schema)
    rest = docs.where(long).select("text", F.struct(*(others or [F.lit(1).alias("_none")])).alias("_rest"))
    stitched = _encode_sections(rest, path, chunk, overlap, section)
    return short.unionByName(stitched.select(*[F.col(f"_rest.{c}").alias(c) for c in others], "ids"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Rows with ids as encode() makes them, with decoded (binary) in place of ids."""
    path = path or vocabulary_path()
    fields = [f for f in encoded.drop("decoded").schema.fields if f.name != "ids"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = token_bytes(path)
        for b in batches:
            texts = once_each(lambda x: b"".join(map(pieces.__getitem__, np.frombuffer(x, dtype="<u4").tolist())), b["ids"])
            yield b.drop(columns="ids").assign(decoded=texts)

    return encoded.drop("decoded").mapInPandas(run, T.StructType([*fields, T.StructField("decoded", T.BinaryType())]))


def digests(docs: DataFrame) -> DataFrame:
    """docs without text, with n_tokens, ids_sha256 and decoded_sha256."""
    ids = encode(docs.drop("n_tokens", "ids_sha256", "decoded_sha256"))
    ids = ids.withColumn("n_tokens", F.expr("octet_length(ids) div 4").cast("long")).withColumn("ids_sha256", F.sha2("ids", 256))
    return decode(ids).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")

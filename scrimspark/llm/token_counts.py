"""Operator 2: token counts with a whole-token shortcut.

Offline, on the driver, every vocabulary string that ends a word is given to the tokenizer alone; those that come back as
that one token are proven. A text is cut at plain white space, over which neither the normaliser nor the pre-tokeniser
ever joins anything; each distinct piece is normalised and pre-tokenised once per task; its pre-tokens that are proven
count one, and only the rest go through the merges. Special strings inside texts are cut out first and count one, as the
library does by default.

Nulls, ties, empty input: a null text counts as empty and has no tokens; repeated rows give repeated rows; an empty table
gives an empty result. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, text_or_empty

VOCABULARY = "word_bpe_49k.json"
PLAIN_SPACE = re.compile("[ \\n\\r\\t]+")
#: Pieces kept with their counts in a task; beyond that the memory starts afresh.
REMEMBERED = 500_000
#: Longer pieces are counted but not remembered.
LONGEST = 64


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


def proven_whole(path: str) -> frozenset[str]:
    """Pre-tokens, as the pre-tokeniser writes them, that the model leaves as one token."""
    t = tokenizer(path)
    suffix = t.model.end_of_word_suffix or ""
    whole = {token: token[: len(token) - len(suffix)] for token in t.get_vocab(with_added_tokens=False) if token.endswith(suffix)}
    return frozenset(bare for token, bare in whole.items() if bare and [x.value for x in t.model.tokenize(bare)] == [token])


class Counter:
    """Counts the tokens of texts; remembers what distinct pieces gave."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.tokenizer, self.whole, self.known = tokenizer(path), whole, {}
        with open(path, encoding="utf-8") as f:
            added = [x["content"] for x in json.load(f)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None

    def piece(self, piece: str) -> int:
        t = self.tokenizer
        normal = t.normalizer.normalize_str(piece) if t.normalizer else piece
        total = 0
        for token, _ in t.pre_tokenizer.pre_tokenize_str(normal):
            total += 1 if token in self.whole else len(t.model.tokenize(token))
        if len(piece) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = total
        return total

    def __call__(self, text: str) -> int:
        total, parts = 0, [text]
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            total = len(parts) - 1
        known = self.known
        for part in parts:
            for piece in PLAIN_SPACE.split(part):
                if piece:
                    n = known.get(piece)
                    total += self.piece(piece) if n is None else n
        return total


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """docs (text and any more) without text, with n_bytes, n_tokens, over_limit. No shuffle; the set of proven strings
    is at most the vocabulary and goes to each task with the function."""
    path = path or vocabulary_path()
    rows = docs.drop("n_bytes", "n_tokens", "over_limit").withColumn("n_bytes", F.octet_length(text_or_empty()).cast("long"))
    fields = [f for f in rows.schema.fields if f.name != "text"]
    whole = rows.sparkSession.sparkContext.broadcast(proven_whole(path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = Counter(path, whole.value)
        for b in batches:
            yield b.drop(columns="text").assign(n_tokens=[count(t or "") for t in b["text"]])

    counted = rows.mapInPandas(run, T.StructType([*fields, T.StructField("n_tokens", T.LongType())]))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_bytes", "n_tokens", "over_limit")

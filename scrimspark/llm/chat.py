"""Operator 1: chat formatting with offset-aligned loss masks.

A conversation is rendered whole, with marks around each turn's role and text; control strings inside roles and texts are
escaped, reversibly. The rendered text is encoded once, with the offsets of its tokens. The tokens of the marks are single
added tokens, so none crosses a turn's edge, and the sorted spans of the assistant's texts are intersected with the sorted
spans of the tokens by binary search.

Nulls, ties, empty input: a null text or role counts as empty; a null turn comes first; turns with the same number go by
role and text; a null conv_id is a conversation of its own; an empty table gives an empty result. Other columns of the
input are not carried, as a conversation is made of many rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

VOCABULARY = "byte_bpe_50k.json"


@dataclass(frozen=True)
class Template:
    """A turn is head + role + middle + text + tail. The three marks are control strings: a control string inside a text
    gets a backslash after its first character, one more if it has some already."""

    head: str = "[INST]"
    middle: str = "[/INST]"
    tail: str = "</s>"
    learned: tuple[str, ...] = ("assistant",)

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.head, self.middle, self.tail

    def pattern(self, least: int) -> str:
        """A mark with ``least`` or more backslashes after its first character."""
        firsts = {m[0] for m in self.marks}
        rests = [m[1:] for m in self.marks]
        if any(not r or "\\" in r or firsts & set(r) for r in rests):
            raise ValueError("a mark needs two characters or more, no backslash, and no first character of a mark further on")
        return "([" + "".join(map(re.escape, sorted(firsts))) + "])" + "\\\\" * least + r"(\\*)(" + "|".join(map(re.escape, rests)) + ")"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.pattern(0)), F.lit(r"$1\\$2$3"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.pattern(1)), F.lit("$1$2$3"))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def tokenizer(path: str, marks: tuple[str, ...]):
    """The tokenizer with the marks as added tokens; strings of other special tokens are ordinary text. Offsets are
    those of the whole tokens, leading spaces included."""
    from tokenizers import AddedToken, Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.add_tokens([AddedToken(m, normalized=False, special=False) for m in marks])
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    return t


def render(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, spans): spans holds (start, end) of each learned text in formatted, in code points. A
    conversation is one training example, so its turns meet in one row, as its text does."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(
        "conv_id",
        F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"), role.alias("role"), text.alias("text")).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(template.head), template.escape(t["role"]), F.lit(template.middle)).alias("before"),
            template.escape(t["text"]).alias("text"),
            t["role"].isin(*template.learned).alias("learned"),
        ),
    )
    rows = whole.select("conv_id", parts.alias("parts"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(a: Column, p: Column) -> Column:
        begin = a["at"] + F.length(p["before"])
        end = begin + F.length(p["text"])
        return F.struct((end + len(template.tail)).alias("at"), F.when(p["learned"], F.concat(a["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(a["spans"]).alias("spans"))

    joined = F.concat_ws("", F.transform("parts", lambda p: F.concat(p["before"], p["text"], F.lit(template.tail))))
    return rows.select("conv_id", joined.alias("formatted"), F.aggregate("parts", start, step, lambda a: a["spans"]).alias("spans"))


def masked_tokens(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """True for tokens (sorted [start, end) rows of offsets) that share a character with one of the sorted spans."""
    mask = np.zeros(len(offsets), dtype=bool)
    if not len(spans) or not len(offsets):
        return mask
    first = np.searchsorted(offsets[:, 1], spans[:, 0], side="right")  # the first token that ends after the span's start
    last = np.searchsorted(offsets[:, 0], spans[:, 1], side="left")  # the first token that starts at its end or later
    for a, b in zip(first, last, strict=True):
        mask[a:b] = True
    return mask


def encode(rendered: DataFrame, path: str | None = None, template: Template = Template()) -> DataFrame:
    """render()'s rows with token_ids, loss_mask (for each token) and loss_spans, the characters under the mask."""
    path = path or vocabulary_path()
    schema = "conv_id " + rendered.schema["conv_id"].dataType.simpleString() + ", formatted string, token_ids array<int>, loss_mask array<boolean>, loss_spans array<struct<start:bigint,end:bigint>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path, template.marks)
        for b in batches:
            ids, masks, under = [], [], []
            for text, spans in zip(b["formatted"], b["spans"], strict=True):
                e = t.encode(text, add_special_tokens=False)
                offsets = np.array(e.offsets, dtype=np.int64).reshape(-1, 2)
                mask = masked_tokens(offsets, np.array([(s["start"], s["end"]) for s in spans], dtype=np.int64).reshape(-1, 2))
                runs: list[list[int]] = []
                for start, end in offsets[mask].tolist():  # tokens of one character's bytes share its offsets
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([start, end])
                ids.append(e.ids)
                masks.append(mask.tolist())
                under.append([{"start": s, "end": x} for s, x in runs])
            yield pd.DataFrame({"conv_id": b["conv_id"], "formatted": b["formatted"], "token_ids": ids, "loss_mask": masks, "loss_spans": under})

    return rendered.mapInPandas(run, schema)


def format_conversations(conversations: DataFrame, path: str | None = None, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, token_ids, loss_mask, loss_spans) of conversations (conv_id, turn, role, text)."""
    return encode(render(conversations, template), path, template)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Rows with turns (array of struct(role, text)) and loss_text, read from formatted and loss_spans alone."""
    pieces = F.split("formatted", F.lit(re.escape(template.tail)))
    turns = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            template.unescape(F.substr(F.substring_index(p, template.middle, 1), F.lit(len(template.head) + 1))).alias("role"),
            template.unescape(F.substr(p, F.length(F.substring_index(p, template.middle, 1)) + len(template.middle) + 1)).alias("text"),
        ),
    )
    learned = F.transform("loss_spans", lambda s: template.unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumn("turns", turns).withColumn("loss_text", F.concat_ws("", learned))


#: Both texts of the conversation that the query adds.
TRICKY = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    back = read_back(format_conversations(rows.unionByName(more)))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: What escaping makes longer by one character, and what a turn's marks add.
ORACLE = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
measured AS (SELECT *, len(regexp_extract_all(role, '[\[<]\\*(?:INST\]|/INST\]|/s>)')) + len(regexp_extract_all(text, '[\[<]\\*(?:INST\]|/INST\]|/s>)')) AS escapes FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(17 + escapes + length(role) + length(text))::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id
"""

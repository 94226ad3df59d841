"""Rendered episodes: the contract between a renderer, a tokenizer and the loss mask.

A renderer gives text, an echo of the episode's structure, and the range of the target's
payload; a tokenizer gives ids and their character ranges.  Ranges are code points, end
exclusive.  Every check is a column; an episode with a fault gets no labels.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ledger import loss_labels

_RANGES = T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()))
CHARACTERS, TOKENS = 1_000_000, 100_000


def offsets_cover(offsets: Column, length: Column) -> Column:
    """Whether token ranges (struct start, end) follow each other without a gap from 0 to ``length``."""
    ends = F.concat(F.array(F.lit(0)), F.transform(offsets, lambda o: o["end"]))
    joined = F.forall(F.zip_with(offsets, F.slice(ends, 1, F.size(offsets)), lambda o, e: (o["start"] == e) & (o["end"] > o["start"])), lambda ok: ok)
    return (F.size(offsets) > 0) & joined & (F.element_at(ends, -1) == length)


def token_range(offsets: Column, start: Column, end: Column) -> Column:
    """Struct start, end of the tokens that make up characters [start, end); null where they do not align."""
    first = F.array_position(F.transform(offsets, lambda o: o["start"]), start)
    last = F.array_position(F.transform(offsets, lambda o: o["end"]), end)
    return F.when((first > 0) & (last >= first), F.struct((first - 1).alias("start"), last.alias("end")))


def rendered(episodes: DataFrame, render: Callable[[dict], dict], encode: Callable[[str], list[tuple[int, int, int]]], column: str = "episode") -> DataFrame:
    """``episodes`` (JSON in ``column``) with what a caller's renderer and tokenizer give, as :func:`contract_faults` takes it.

    ``render`` gives text, structure, truncated and ranges [(start, end)]; ``encode`` gives (id, start, end) of a text's tokens.
    """
    made = [
        T.StructField("text", T.StringType()), T.StructField("structure", T.StringType()), T.StructField("truncated", T.BooleanType()),
        T.StructField("ranges", _RANGES), T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("offsets", _RANGES),
    ]
    names = [f.name for f in (*episodes.schema.fields, *made)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for episode in part[column]:
                out = render(json.loads(episode))
                tokens = encode(out["text"])
                ranges = lambda spans: [{"start": a, "end": b} for a, b in spans]
                rows.append((out["text"], out["structure"], out["truncated"], ranges(out["ranges"]), [t[0] for t in tokens], ranges(t[1:] for t in tokens)))
            more = pd.DataFrame(rows, columns=[f.name for f in made], index=part.index)
            yield pd.concat([part, more], axis=1)[names]

    return episodes.mapInPandas(run, T.StructType([*episodes.schema.fields, *made]))


def contract_faults(rendered: DataFrame, max_characters: int = CHARACTERS, max_tokens: int = TOKENS) -> DataFrame:
    """``rendered`` with its first fault, null for none.

    Columns: text, truncated, expected_structure and structure (hashes of what is not
    language), payload (canonical JSON of the target message), ranges (array of struct start, end),
    token_ids, offsets.
    """
    text, one = F.col("text"), F.get("ranges", F.lit(0))
    said = F.substring(text, one["start"] + 1, one["end"] - one["start"])
    rules = (
        (F.col("truncated"), "truncated"),
        (F.coalesce(text, F.lit("")) == "", "empty_text"),
        (F.length(text) > max_characters, "text_too_long"),
        (~F.col("structure").eqNullSafe(F.col("expected_structure")), "structure_changed"),
        (F.size("ranges") != 1, "not_one_payload_range"),
        (one["end"] > F.length(text), "range_outside_text"),
        (~said.eqNullSafe(F.col("payload")), "payload_differs"),
        (F.size("token_ids") > max_tokens, "too_many_tokens"),
        (F.size("token_ids") != F.size("offsets"), "ids_without_offsets"),
        (~offsets_cover(F.col("offsets"), F.length(text)), "offsets_do_not_cover"),
        (token_range(F.col("offsets"), one["start"], one["end"]).isNull(), "target_cuts_a_token"),
    )
    return rendered.withColumn("fault", F.coalesce(*(F.when(test, F.lit(name)) for test, name in rules)))


def supervised(rendered: DataFrame, **limits: int) -> DataFrame:
    """``rendered`` with fault and labels: the target's ids, the ignored label elsewhere; null where there is a fault."""
    one = F.get("ranges", F.lit(0))
    target = token_range(F.col("offsets"), one["start"], one["end"])
    labels = loss_labels(F.col("token_ids"), target["start"], target["end"])
    return contract_faults(rendered, **limits).withColumn("labels", F.when(F.col("fault").isNull(), labels))

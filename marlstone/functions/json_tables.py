"""Leaves and segments as table functions of SQL: rows instead of one array for each document.

After :func:`register`::

    SELECT e.id, l.pointer, l.value FROM events e, LATERAL json_leaves(e.props) l
    SELECT * FROM episode_segments(TABLE(episodes), 'episode', '{"version": "p1"}')
    SELECT * FROM episode_segments(TABLE(episodes) PARTITION BY (id), 'episode', '{"version": "p1"}')

``json_leaves`` gives (pointer, value) of each leaf as :func:`.json_tree.leaf_rows` does.
``episode_segments`` keeps a table's other columns and adds, for each text to translate, its pointer,
text, digest, id and its place among the episode's segments; an episode that the policy or the
reader refuses is one row with a ``code`` and the pointer of the fault.  The policy is JSON with fields of
``FieldPolicy``.  No key is needed, as each row stands alone; with PARTITION BY the rows of a
key come from one task, one after the other.

Defined results: null JSON or a null episode gives no row; empty tables give none; a table's own
column of an added name, or a column or policy that is not there, fails when the query is analysed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import IntegerType, StringType, StructType

from . import json_tree
from .jcs import canonical

_ADDED = (("position", IntegerType()), ("json_pointer", StringType()), ("source_text", StringType()), ("source_sha256", StringType()), ("segment_id", StringType()), ("code", StringType()))


class JsonLeaves:
    @staticmethod
    def analyze(text: AnalyzeArgument, empties: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not isinstance(text.dataType, StringType):
            raise ValueError("json_leaves takes a text")
        return AnalyzeResult(StructType().add("pointer", StringType()).add("value", StringType()))

    def eval(self, text: str | None, empties: bool | None = True) -> Iterator[tuple[str, str | None]]:
        if text is None:
            return
        try:
            # a fault may come up late: nothing is given before all of it was read
            found = [(pointer, canonical(value)) for pointer, value in json_tree.leaves(json.loads(text), empties is not False)]
        except (ValueError, RecursionError):
            found = [("PARSE_INVALID_JSON", None)]
        yield from found


def policy_of(text: str):
    """A field policy from its JSON; (tool, pointer) keys of ``arguments`` are written as "tool pointer"."""
    from ..operators.tools import FieldPolicy

    fields = json.loads(text)
    if "arguments" in fields:
        fields["arguments"] = {tuple(key.split(" ", 1)): action for key, action in fields["arguments"].items()}
    return FieldPolicy(**fields)


class EpisodeSegments:
    def __init__(self) -> None:
        self._policy, self._policy_text = None, None

    @staticmethod
    def analyze(rows: AnalyzeArgument, episode: AnalyzeArgument, policy: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or not episode.isConstantExpression or not policy.isConstantExpression:
            raise ValueError("episode_segments takes a table, the name of its episode column and a constant policy")
        if episode.value not in rows.dataType.names:
            raise ValueError(f"the table has no column {episode.value}")
        policy_of(policy.value)
        kept = [f for f in rows.dataType.fields if f.name != episode.value]
        if clash := {f.name.lower() for f in kept} & {name for name, _ in _ADDED}:
            raise ValueError(f"the table has a column {sorted(clash)[0]} already")
        schema = StructType(kept)
        for name, kind in _ADDED:
            schema = schema.add(name, kind)
        return AnalyzeResult(schema)

    def eval(self, row: Row, episode: str, policy: str) -> Iterator[tuple]:
        from ..operators.tools import EpisodeError, segments_of

        if policy != self._policy_text:
            self._policy, self._policy_text = policy_of(policy), policy
        kept, text = [row[name] for name in row.__fields__ if name != episode], row[episode]
        if text is None:
            return
        try:
            found = segments_of(json.loads(text), self._policy)
        except EpisodeError as error:
            yield (*kept, None, error.pointer, None, None, None, error.code)
            return
        except (ValueError, RecursionError):
            yield (*kept, None, None, None, None, None, "PARSE_INVALID_JSON")
            return
        for place, s in enumerate(found):
            yield (*kept, place, s["json_pointer"], s["source_text"], s["source_sha256"], s["segment_id"], None)


def register(spark: SparkSession) -> None:
    """Make ``json_leaves`` and ``episode_segments`` known to the session's SQL."""
    spark.udtf.register("json_leaves", udtf(JsonLeaves))
    spark.udtf.register("episode_segments", udtf(EpisodeSegments))

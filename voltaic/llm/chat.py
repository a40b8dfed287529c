"""Chat formatting from an event log.

Final messages are folded from events: the log is partitioned by conversation
and sorted by message and sequence number, and each message's events are
applied in turn. ``message`` starts a message with its role and text,
``delta`` appends streamed text, ``edit`` replaces the text, ``regenerate``
starts the text anew, ``delete`` removes the message. Folded messages are
rendered by a template whose control strings are escaped inside texts, so the
output can be read back exactly.

Tasks stream: a task holds one message and one rendered block at a time. The
log is partitioned by ranges of (conversation, turn, part), so a very long
conversation spreads over tasks, whatever its turn numbers are. A task closes a
block after ``BLOCK_TURNS`` messages or ``BATCH_CHARS`` characters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltaic.llm.common import chunks

#: The template's control strings and the escape character.
OPEN, BETWEEN, CLOSE, ESCAPE = "### ", ": ", "</turn>\n", "\\"
#: The role whose text is under the loss mask.
LOSS_ROLE = "assistant"
BLOCK_TURNS = 1000
#: Characters and rows of a batch that a task sends back.
BATCH_CHARS = 4 << 20
BATCH_ROWS = 1000
EVENTS = ["conv_id", "turn", "part", "seq", "kind", "role", "text"]

_TEXT = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_BACK = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ([^\\:]*(?:\\(?:\\|###|</turn>|:)[^\\:]*)*): ([^\\<]*(?:(?:\\(?:\\|###|</turn>)|<(?!/turn>))[^\\<]*)*)</turn>\n")


def escape(text: str, pattern: re.Pattern = _TEXT) -> str:
    """Put a backslash before each backslash and control string."""
    return pattern.sub(lambda m: ESCAPE + m.group(), text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def render(turns: Iterable[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text of (role, text) turns, and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role, _ROLE) + BETWEEN, escape(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a formatted text; the inverse of ``render``."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


def fold(events: Iterable[tuple[str, str, str]]) -> tuple[str, str] | None:
    """(role, text) after (kind, role, text) events of one message, or None.

    The last role given counts. Unknown and NULL kinds change nothing.
    """
    role, text, alive = "", [], False
    for kind, who, what in events:
        if kind not in ("message", "delta", "edit", "regenerate", "delete"):
            continue
        alive = kind != "delete"
        if kind != "delta":
            text = []
        if alive:
            text.append(what or "")
            role = role if who is None else who
    return (role, "".join(text)) if alive else None


def format_log(events: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Final messages of an event log, rendered.

    ``events`` has the columns of ``EVENTS``; others are ignored. Messages
    are told apart and ordered by (``turn``, ``part``); events of a message by
    ``seq``, then kind, role and text, so ties have one result; repeated
    events are applied as often as they occur. NULL turns come first; a NULL
    conversation is one of its own; NULL roles and texts are empty. Returns,
    per conversation and block of turns: ``conv_id``, ``block`` (numbers in
    the order of the blocks, with gaps; below 0 where turns are NULL),
    ``n_turns``, ``formatted`` and ``loss_spans`` (start and end code points
    in ``formatted``). A conversation without a message has no row; an empty
    log gives an empty result. One task folds all events of one message.
    """
    conv = events.schema["conv_id"].dataType.simpleString()
    source = events.select(*EVENTS[:4], *[F.col(c).cast("string").alias(c) for c in EVENTS[4:]])
    source = source.repartitionByRange("conv_id", "turn", "part").sortWithinPartitions("conv_id", "turn", "part", "seq", "kind", "role", "text")
    source = source.select("conv_id", "turn", "part", "kind", "role", "text")
    most_turns, most_chars = BLOCK_TURNS, BATCH_CHARS

    def run(batches):
        now, message, own, turns, held = None, None, [], [], 0
        # Partitions are in the order of the log, and so are blocks within one.
        number = TaskContext.get().partitionId() << 32

        def rows():
            for batch in chunks(batches, "text"):
                yield from zip(*[c.to_pylist() for c in batch.columns])

        def close():
            nonlocal held
            if own and (done := fold(own)) is not None:
                turns.append(done)
                held += len(done[0]) + len(done[1])
            own.clear()

        def finish():
            nonlocal held, number
            out = []
            if turns:
                text, spans = render(turns, loss_role)
                at = number - (1 << 62) if now[1] else number
                out.append((now[0], at, len(turns), text, [{"start": a, "end": b} for a, b in spans]))
                turns.clear()
            held = 0
            number += 1
            return out

        for c, turn, part, kind, role, text in rows():
            if message != (c, turn, part):
                close()
                message = (c, turn, part)
                if now != (c, turn is None) or len(turns) >= most_turns or held >= most_chars:
                    yield from finish()
                    now = (c, turn is None)
            own.append((kind, role, text))
        close()
        yield from finish()

    schema = f"conv_id {conv}, block long, n_turns long, formatted string, loss_spans array<struct<start:int,end:int>>"
    types = _arrow_types(schema)
    return source.mapInArrow(lambda batches: _batches(run(batches), types, text=3), schema)


def _arrow_types(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _batches(rows: Iterator[tuple], types: pa.Schema, text: int | None = None) -> Iterator[pa.RecordBatch]:
    """Gather rows into Arrow batches of bounded rows and bounded text."""
    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*own), types)], schema=types)

    own, held = [], 0
    for row in rows:
        own.append(row)
        held += len(row[text]) if text is not None else 0
        if held >= BATCH_CHARS or len(own) >= BATCH_ROWS:
            yield batch()
            own, held = [], 0
    if own:
        yield batch()


def events_of(conversations: DataFrame) -> DataFrame:
    """The event log of plain conversation rows (conv_id, turn, role, text).

    Each row becomes a ``message`` event with its role and a ``delta`` event
    with its text. Rows that share a turn stay messages of their own, ordered
    by role and text. Rows are numbered in that order by a sort in ranges,
    which the number of a row as read splits where rows are alike, so no turn,
    NULL included, is one group.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.withColumn("read", F.monotonically_increasing_id()).repartitionByRange(*order, "read").sortWithinPartitions(*order, "read")
    rows = rows.select("conv_id", "turn", F.monotonically_increasing_id().alias("part"), "role", "text")
    null = F.lit(None).cast("string")
    event = lambda seq, kind, role, text: F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))
    return rows.select("conv_id", "turn", "part", F.inline(F.array(event(0, "message", F.col("role"), null), event(1, "delta", null, F.col("text")))))


def read_back(formatted: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Digests per conversation, parsed from rendered blocks.

    Returns ``conv_id``, ``n_turns``, ``turns_sha256`` (role, newline, text,
    newline per turn), ``loss_chars`` and ``loss_sha256`` (unescaped text
    under the loss mask) and ``formatted_chars``. Blocks stream in order
    through running hashes; a task holds one block.
    """
    conv = formatted.schema["conv_id"].dataType.simpleString()
    source = formatted.select("conv_id", "block", "formatted", "loss_spans").repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "formatted", "loss_spans")

    def rows(batches):
        now, some = None, False
        for batch in chunks(batches, "formatted"):
            for c, text, spans in zip(*[x.to_pylist() for x in batch.columns]):
                if not some or c != now:
                    if some:
                        yield done(now)
                    now, some = c, True
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    done = lambda key, s=state: (key, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescape(text[span["start"] : span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
        if some:
            yield done(now)

    schema = f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    types = _arrow_types(schema)
    return source.mapInArrow(lambda batches: _batches(rows(batches), types), schema)


#: A conversation whose texts hold the template's own control strings.
PROBE = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def with_probe(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text")
    return rows.unionByName(rows.sparkSession.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))


#: The same digests in DuckDB SQL.
ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
    4 + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g')) + 2 + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + 8 AS size
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

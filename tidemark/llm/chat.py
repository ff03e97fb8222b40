"""Conversations as training text, by a compiled template.

The template's one top-level node is a loop over the turns, so that each turn is rendered
by itself, in any number of tasks: a conversation's text is its turns' texts in order,
however many there are. Texts are escaped so that no control string stands in them, and
can be read back: a backslash is doubled, and ``<|`` gets one in between; in roles line
ends are written ``\\n``.

Digests of a conversation need its turns in order. They are sorted within partitions and
streamed through a running hash, one turn at a time, so that a conversation with a third
of all turns takes time but no memory.

Defined results: null texts and roles are empty; a null turn number comes first; turns of
the same number are ordered by role and text, repeated rows are repeated turns; turns
without a conversation id form the conversation null. No rows, no conversations.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import BATCH_ROWS, map_text
from tidemark.llm.template import Loop, Template, TemplateError

START, END = "<|im_start|>", "<|im_end|>"
CHAT = (
    "{% for message in messages %}"
    + START
    + "{{ message.role | line }}\n"
    + "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    + "{% else %}{{ message.text | escape }}{% endif %}"
    + END
    + "\n{% endfor %}"
)
_SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


FILTERS = {"escape": escape, "line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower}


def compiled(source: str) -> Template:
    """A template that renders turn by turn."""
    template = Template(source, FILTERS)
    if len(template.tree) != 1 or not isinstance(template.tree[0], Loop):
        raise TemplateError("the template must be one loop over the turns")
    return template


def read_back(text: str, spans: list[tuple[int, int]]) -> list[tuple[str, str, str]]:
    """(role, text, text under the mask) of every turn of a formatted text, unescaped."""
    turns = []
    for m in _TURN.finditer(text):
        marked = [text[max(a, m.start()) : min(b, m.end())] for a, b in spans if a < m.end() and b > m.start()]
        turns.append((unescape(m[1]), unescape(m[2]), unescape("".join(marked))))
    return turns


def format_turns(
    turns: DataFrame, template: str = CHAT, role: str = "role", text: str = "text", formatted: str = "formatted", spans: str = "spans"
) -> DataFrame:
    """``turns`` with each turn's part of the formatted text and its marked spans."""
    names = [name for name in turns.columns if name not in (formatted, spans)]
    compiled(template)
    made: list[Template] = []  # one for each task

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(compiled(template))
        roles, texts = batch.column(role).to_pylist(), batch.column(text).to_pylist()
        done = [
            made[0].render(messages=[{"role": r or "", "text": t or ""}]) for r, t in zip(roles, texts, strict=True)
        ]
        marks = pa.array([[{"start": a, "end": b} for a, b in found] for _, found in done], _SPANS)
        columns = [*(batch.column(n) for n in names), pa.array([t for t, _ in done], pa.string()), marks]
        return pa.RecordBatch.from_arrays(columns, [*names, formatted, spans])

    kept = turns.select(*[F.col(f"`{name}`") for name in names])
    added = [StructField(formatted, StringType()), StructField(spans, ArrayType(_SPAN))]
    return map_text(kept, work, StructType([*kept.schema.fields, *added]), text)


def digests(parts: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Per conversation what its formatted text says, read back from the text and its mask."""
    sort = [F.col(c).asc_nulls_first() for c in (conversation, turn, "role", "text")]
    parts = parts.select(conversation, turn, F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "formatted", "spans")
    parts = parts.repartition(conversation).sortWithinPartitions(*sort).select(conversation, "formatted", "spans")
    parts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    names = [conversation, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        current, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for key, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if state is None or key != current:
                    if state:
                        done.append(_closed(current, state))
                    current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body, loss in read_back(text, [(s["start"], s["end"]) for s in spans]):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(text)
            if done:
                yield _batch(done, names)
        if state:
            yield _batch([_closed(current, state)], names)

    kind = parts.schema[0].dataType.simpleString()
    return parts.mapInArrow(
        run,
        f"`{conversation}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _closed(key, state: list) -> tuple:
    return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

"""Chat formatting by schema fingerprints.

Records of unlike layouts (prompt and response, instruction and output, lists of
messages, one row a turn) come as JSON. The paths of a record's fields that a
declarative mapping knows are hashed; the first mapping that has this hash says
where the turns are.
Canonical turns are then written in one template that can be read back exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import ship

# Names of roles in other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
ASSISTANT = "assistant"
OPEN, END = "### ", " </turn>\n"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``paths`` must all be there, ``optional`` may be; other fields of a record
    are of no account, whatever they are in other mappings. Either ``items`` names the list of messages, with the
    fields of ``role`` and ``text`` inside it, after the (role, fields) of
    ``turns``, or ``turns`` alone says where they are; texts of several fields
    are joined. ``row`` holds for records that are one turn each.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    items: str | None = None
    role: str = ""
    text: str = ""
    order: str | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    row: bool = False


# In the order of precedence: a record that fits several is read by the first.
MAPPINGS = (
    Mapping("turn rows", ("role", "text", "turn"), row=True, role="role", text="text", order="turn"),
    Mapping("prompt", ("prompt", "response"), ("system", "input"), turns=(("system", ("system",)), ("user", ("prompt", "input")), (ASSISTANT, ("response",)))),
    Mapping("completion", ("prompt", "completion"), ("system", "input"), turns=(("system", ("system",)), ("user", ("prompt", "input")), (ASSISTANT, ("completion",)))),
    Mapping("instruction", ("instruction", "output"), ("input", "system"), turns=(("system", ("system",)), ("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Mapping("question", ("question", "answer"), ("system",), turns=(("system", ("system",)), ("user", ("question",)), (ASSISTANT, ("answer",)))),
    Mapping("messages", ("messages", "messages[]", "messages[].content", "messages[].role"), ("system",), turns=(("system", ("system",)),), items="messages", role="role", text="content"),
    Mapping("conversations", ("conversations", "conversations[]", "conversations[].from", "conversations[].value"), ("system",), turns=(("system", ("system",)),), items="conversations", role="from", text="value"),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """All paths of a nested value; the items of a list share one path."""
    out: set[str] = set()
    if isinstance(value, dict):
        for k, v in value.items():
            path = f"{prefix}.{k}" if prefix else k
            out |= {path} | field_paths(v, path)
    elif isinstance(value, list):
        for v in value:
            out |= {f"{prefix}[]"} | field_paths(v, f"{prefix}[]")
    return out


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


class Layouts:
    """Mappings by the fingerprints of the sets of paths they stand for, in the order of precedence."""

    def __init__(self, mappings: tuple[Mapping, ...] = MAPPINGS):
        self.known = {p for m in mappings for p in (*m.paths, *m.optional)}
        self.prints: list[tuple[Mapping, set[str], set[str]]] = []
        for m in mappings:
            some = chain.from_iterable(combinations(m.optional, n) for n in range(len(m.optional) + 1))
            self.prints.append((m, {*m.paths, *m.optional}, {fingerprint({*m.paths, *s}) for s in some}))

    def of(self, record) -> tuple[str, Mapping | None]:
        """Fingerprint and mapping of a record; each mapping sees its own paths only. Without one, that of all known paths."""
        paths = field_paths(record)
        for mapping, own, prints in self.prints:
            if (print_ := fingerprint(paths & own)) in prints:
                return print_, mapping
        return fingerprint(paths & self.known), None


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record, mapping: Mapping) -> list[tuple[int, str, str]]:
    """(order, role, text) of a record's turns; absent or null texts of a fixed turn leave it out, except for the answer."""
    if mapping.row:
        order = record.get(mapping.order) if mapping.order else None
        return [(order if isinstance(order, int) and not isinstance(order, bool) else None, _text(record.get(mapping.role)), _text(record.get(mapping.text)))]
    out = []
    for role, fields in mapping.turns:
        texts = [_text(record[f]) for f in fields if record.get(f) is not None]
        texts = [t for t in texts if t] or texts[:1]
        if texts or role == ASSISTANT:
            out.append((len(out), role, "\n".join(texts)))
    if mapping.items:
        for item in record[mapping.items]:
            role = _text(item.get(mapping.role))
            out.append((len(out), ROLES.get(role, role), _text(item.get(mapping.text))))
    return out


def readable_turns(raw: str | None, layouts: Layouts) -> tuple[str | None, Mapping | None, list[tuple[int | None, str, str]]]:
    """Fingerprint, mapping and turns of a record; no mapping for one that can't be read.

    That is text that is no JSON or too deeply nested, items that are no
    objects, an order beyond 64 bits, and characters that are halves of a pair,
    which no text can hold.
    """
    print_ = None
    try:
        record = json.loads(raw) if raw is not None else None
        if not isinstance(record, dict):
            return None, None, []
        print_, mapping = layouts.of(record)
        if mapping is None or mapping.items and not all(isinstance(item, dict) for item in record[mapping.items]):
            return print_, None, []
        turns = turns_of(record, mapping)
        "".join(role + text for _, role, text in turns).encode()
    except (ValueError, RecursionError):
        return print_, None, []
    if any(order is not None and not -(1 << 63) <= order < 1 << 63 for order, _, _ in turns):
        return print_, None, []
    return print_, mapping, turns


def escape(text: str) -> str:
    """Without any control string: no mark of the template is left, and ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: m[1], text, flags=re.DOTALL)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and the span of its text."""
    head = f"{OPEN}{escape_role(role)}\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, _, rest = formatted.removeprefix(OPEN).partition("\n")
    return unescape_role(role), unescape(rest.removesuffix(END))


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, layout, fingerprint, turn, role, text, record) of every turn of every record.

    ``records`` has conv_id and record, a JSON object as text; other columns are
    not read. A record that is null, no JSON object, or of no known layout is one
    row with a null layout, role and text, never dropped; ``record`` keeps it as
    it came, and is null in rows of known layouts. So is one that its layout
    can't read (see ``readable_turns``). A known layout without
    turns (an empty list has another fingerprint) doesn't occur. Repeated records
    give repeated turns.
    """
    ship(records.sparkSession)

    def map_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts = Layouts(mappings)
        for batch in batches:
            at, rows = [], []
            for i, raw in enumerate(batch.column("record").to_pylist()):
                print_, mapping, turns = readable_turns(raw, layouts)
                found = [(mapping.name, print_, *t, None) for t in turns] if mapping else [(None, print_, None, None, None, raw)]
                at += [i] * len(found)
                rows += found
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(at, pa.int64())), *columns], ["conv_id", "layout", "fingerprint", "turn", "role", "text", "record"])

    rows = records.select("conv_id", F.col("record").cast("string").alias("record"))
    return rows.mapInArrow(map_, f"conv_id {dict(rows.dtypes)['conv_id']}, layout string, fingerprint string, turn bigint, role string, text string, record string")


def format_chat(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, record, formatted, loss_start, loss_end), one row a turn.

    A conversation's text is its ``formatted`` values in the order of (turn,
    role, text), so it may have any number of turns. ``loss_start`` and
    ``loss_end`` bound the text under the loss mask, in code points of
    ``formatted``; both are 0 where the role is not the assistant's. Rows
    without a layout are left as they are: ``formatted`` is null, ``record`` is what came. Null roles and
    texts count as empty.
    """
    ship(turns.sparkSession)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for layout, role, text in zip(*(batch.column(c).to_pylist() for c in ("layout", "role", "text"))):
                if layout is None:
                    rows.append((None, 0, 0))
                    continue
                formatted, a, b = format_turn(role or "", text or "")
                rows.append((formatted, a, b) if role == ASSISTANT else (formatted, 0, 0))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "turn", "role", "text", "record")), *columns], ["conv_id", "turn", "role", "text", "record", "formatted", "loss_start", "loss_end"])

    rows = turns.select("conv_id", "layout", "turn", "role", "text", "record")
    return rows.mapInArrow(render, f"conv_id {dict(rows.dtypes)['conv_id']}, turn bigint, role string, text string, record string, formatted string, loss_start bigint, loss_end bigint")


def read_back(chat: DataFrame) -> DataFrame:
    """Digests of every conversation, from formatted turns and their masks alone.

    Turns of a conversation are sorted and read one by one: a conversation of
    any length needs memory for one turn only. Records of unknown layouts have no
    turns to read; they stay in the rows of ``format_chat``.
    """
    ship(chat.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, state, kind = None, None, pa.int64()

        def close(done: list) -> pa.RecordBatch:
            kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done) if done else [[]] * 6, kinds)], names)

        def row() -> tuple:
            n, turns, loss_chars, loss, chars = state
            return now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        for batch in batches:
            done, kind = [], batch.column("conv_id").type
            for conv, formatted, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
                if state is None or conv != now:
                    if state is not None:
                        done.append(row())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(formatted)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[4] += len(formatted)
                masked = unescape(formatted[a:b])
                state[2] += len(masked)
                state[3].update(masked.encode())
            yield close(done)
        if state is not None:
            yield close([row()])

    rows = chat.where("formatted IS NOT NULL").select("conv_id", "turn", "role", "text", "formatted", "loss_start", "loss_end")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "formatted", "loss_start", "loss_end")
    return rows.mapInArrow(digest, f"conv_id {dict(rows.dtypes)['conv_id']}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")

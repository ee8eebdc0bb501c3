"""Chat formatting with a loss mask aligned to token offsets.

A turn is rendered as ``<|turn|>role<|text|>text<|end|>`` and a line break. The three control
strings are added to the tokenizer as special tokens, so no token reaches over one. Inside
roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, which ``unescape`` undoes.

Rows are sorted by conversation and turn within partitions and streamed. A conversation is
rendered whole and encoded once, with the offsets of its tokens; the spans of assistant texts
and the token spans are both sorted, so two binary searches a span give its tokens. Very long
conversations are cut into parts at a turn's end, which changes no token, so memory is bounded
by ``PART_CHARS`` and the longest text.

Null texts and roles are empty. Rows with the same turn number follow each other by role, then
text; rows without a number come first. Rows without a conversation id are one conversation.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from hitlist.llm.shared import bound_batches, load_tokenizer

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"
#: Rendered characters after which a part ends with the turn.
PART_CHARS = 4_000_000

_TOKENIZERS: dict = {}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def tokenizer(path: str):
    if path not in _TOKENIZERS:
        tok = load_tokenizer(path)
        tok.add_special_tokens([TURN, TEXT, END])
        _TOKENIZERS[path] = tok
    return _TOKENIZERS[path]


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns, and the spans of the texts the loss is taken on."""
    out, spans, at = [], [], 0
    for role, text in turns:
        opening, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == LOSS_ROLE and body:
            spans.append((at + len(opening), at + len(opening) + len(body)))
        out.append(f"{opening}{body}{END}\n")
        at += len(out[-1])
    return "".join(out), spans


def loss_mask(offsets, spans: list[tuple[int, int]]):
    """True for tokens that overlap a span; both in order of the text."""
    import numpy as np

    starts, ends = offsets[:, 0], offsets[:, 1]
    mask = np.zeros(len(offsets), bool)
    for a, b in spans:
        mask[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = True
    return mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for turn in formatted.split(f"{END}\n")[:-1]:
        role, text = turn[len(TURN) :].split(TEXT, 1)
        out.append((unescape(role), unescape(text)))
    return out


def masked_text(formatted: str, offsets, mask) -> str:
    """What the masked tokens stand for, unescaped; tokens of one character's bytes share it."""
    import numpy as np

    out, reached = [], 0
    for a, b in offsets[np.flatnonzero(mask)].tolist():
        if b > reached:
            out.append(formatted[max(a, reached) : b])
            reached = b
    return unescape("".join(out))


def _parts(batches):
    """(conv_id, turns, whether the conversation goes on) from sorted rows."""
    current, turns, size, started = None, [], 0, False
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
        for conv, role, text in zip(*columns):
            if started and conv != current:
                yield current, turns, False
                turns, size = [], 0
            elif size >= PART_CHARS:
                yield current, turns, True
                turns, size = [], 0
            current, started = conv, True
            turns.append((role or "", text or ""))
            size += len(turns[-1][0]) + len(turns[-1][1])
    if started:
        yield current, turns, False


def _encode(path: str, turns):
    import numpy as np

    formatted, spans = render(turns)
    encoded = tokenizer(path).encode(formatted, add_special_tokens=False)
    offsets = np.asarray(encoded.offsets, np.int64).reshape(-1, 2)
    return formatted, encoded.ids, offsets, loss_mask(offsets, spans)


def _formatted(path: str, id_type):
    def rows(batches):
        import pyarrow as pa

        part, out, size = 0, [], 0

        def batch():
            conv, parts, text, ids, mask = zip(*out)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(conv, id_type),
                    pa.array(parts, pa.int32()),
                    pa.array(text, pa.string()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(mask, pa.list_(pa.bool_())),
                ],
                names=["conv_id", "part", "formatted", "input_ids", "loss_mask"],
            )

        for conv, turns, more in _parts(batches):
            formatted, ids, _, mask = _encode(path, turns)
            out.append((conv, part, formatted, ids, mask.tolist()))
            part, size = part + 1 if more else 0, size + len(formatted)
            if size >= PART_CHARS or len(out) >= 500:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    return rows


def _digests(path: str, id_type):
    def rows(batches):
        import pyarrow as pa

        def batch():
            columns = list(zip(*out))
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        out, state = [], None
        for conv, turns, more in _parts(batches):
            formatted, _, offsets, mask = _encode(path, turns)
            if state is None:
                state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            back = parse(formatted)
            state[0] += len(back)
            for role, text in back:
                state[1].update(f"{role}\n{text}\n".encode())
            loss = masked_text(formatted, offsets, mask)
            state[2] += len(loss)
            state[3].update(loss.encode())
            state[4] += len(formatted)
            if not more:
                out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                state = None
            if len(out) >= 2000:
                yield batch()
                out = []
        if out:
            yield batch()

    return rows


def _sorted(conversations: DataFrame) -> DataFrame:
    bound_batches(conversations.sparkSession, 2000)
    order = ["conv_id", "turn", "role", "text"]
    return conversations.select(*order).repartition("conv_id").sortWithinPartitions(*order)


def _types(conversations: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = conversations.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def format_conversations(conversations: DataFrame, path: str) -> DataFrame:
    """(conv_id, part, formatted, input_ids, loss_mask); most conversations have one part."""
    name, arrow = _types(conversations)
    return _sorted(conversations).mapInArrow(
        _formatted(path, arrow),
        f"conv_id {name}, part int, formatted string, input_ids array<int>, loss_mask array<boolean>",
    )


def digests(conversations: DataFrame, path: str) -> DataFrame:
    """Per conversation, read back from the formatted text and its mask: n_turns,
    turns_sha256, loss_chars, loss_sha256 and formatted_chars."""
    name, arrow = _types(conversations)
    return _sorted(conversations).mapInArrow(
        _digests(path, arrow),
        f"conv_id {name}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )

"""Conversations as prefix trees: shared first turns stand once in a training text.

A turn is written as ``<turn role>text</turn>`` and a line break. In roles and texts
the backslash and both angle brackets are escaped by a backslash and a letter, so
no text can hold a control string, and reading gives every text back.

A turn's node is a hash of all turns up to it, so conversations that begin alike share
nodes. Conversations are sorted by the path of their nodes, which is the depth-first
order of the tree, and one pass writes each node's text when it comes first. Output is
packs: a text, the position at which each of its nodes begins in every conversation
that holds it, and for each conversation the intervals of the pack that make it up.
A token may attend to what comes before it in its own conversation's intervals, which
are those of its ancestors. Positions and intervals count code points. Conversations
with one path are one entry with a list of ids. A pack has one tree and ends beyond PACK
characters or HELD ids and intervals; a larger tree goes on in the next pack, where
the path to its first conversation is written again. So a pack is bounded, however
many conversations are copies of one.

A conversation longer than SEGMENT characters or SEGMENT_TURNS turns is a chain of
segments, cut where the same turns are always cut. Segments that go on from the same node
are a tree of their own, packed like the others and shared likewise. Such a pack names the
pack ``above`` it and the intervals there that lead up to it, to which the tokens of all that
it holds attend too, and to what that pack in turn names. That is one reference a pack, so
they grow with the segments alone; ``lineage`` follows them. A pack is named by its first
conversation and segment.

Turns are ordered by ``turn`` (nulls last), then role and text; null role or text counts
as empty. Rows with a null conv_id are one conversation with that id. Repeated rows are
turns of their own. Other columns are ignored; an empty table gives no packs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamrank.llm.batches import bound_batches
from roamrank.workspace import write_table

PACK = 200_000
#: Ids and intervals of a pack.
HELD = 20_000
#: Characters of conversations cut out of their packs at a time.
CUT_CHARS = 4 << 20
SEGMENT = 100_000
SEGMENT_TURNS = 256
#: Bytes of each node's hash that paths are sorted by; nodes are compared by all of theirs.
ORDER = 8
LEARN = "assistant"

# The escapes. The backslash comes first when escaping.
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), (">", "\\g"))
PLAIN = {"\\\\": "\\", "\\l": "<", "\\g": ">"}
TURN = re.compile(r"<turn ([^<>]*)>([^<>]*)</turn>\n")

INTERVAL = "struct<begin:int,end:int>"
ABOVE = f"struct<pack:string,intervals:array<{INTERVAL}>>"
PACKS = (
    "pack string, text string, nodes array<struct<begin:int,end:int,position:bigint,parent:int>>, "
    f"conversations array<struct<ids:array<bigint>,known:boolean,segment:int,intervals:array<{INTERVAL}>>>"
)


def escape(text: str) -> str:
    for plain, written in ESCAPES:
        text = text.replace(plain, written)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lg]", lambda m: PLAIN[m[0]], text) if "\\" in text else text


def written(role: str, text: str) -> str:
    return f"<turn {escape(role)}>{escape(text)}</turn>\n"


def turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text, and where the escaped text stands, of each turn of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2]), *m.span(2)) for m in TURN.finditer(formatted)]


def _node(parent: bytes, role: str, text: str) -> bytes:
    own = hashlib.blake2b(parent, digest_size=16)
    own.update(f"{len(role)}:{role}:{text}".encode("utf-8", "surrogatepass"))
    return own.digest()


class _Conversation:
    """The segment being gathered of one conversation."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.segment, self.position = conv_id, 0, 0
        self.last = b""
        self.clear()

    def clear(self) -> None:
        self.parts, self.nodes, self.chars, self.begin = [], [], 0, self.position
        self.above = self.last  # the node that the segment goes on from, none for the first

    def add(self, role: str, text: str) -> None:
        self.last = _node(self.last, role, text)
        self.nodes.append(self.last)
        self.parts.append(written(role, text))
        self.chars += len(self.parts[-1])
        self.position += len(self.parts[-1])

    def full(self) -> bool:
        return self.chars >= SEGMENT or len(self.nodes) >= SEGMENT_TURNS

    def row(self) -> tuple:
        key = self.above[:ORDER].rjust(ORDER, b"\0") + b"".join(n[:ORDER] for n in self.nodes)
        out = (self.conv_id, self.segment, self.begin, key, self.above, self.nodes, self.parts)
        self.segment += 1
        self.clear()
        return out


SEGMENTS = (
    "conv_id bigint, segment int, position bigint, key binary, above binary, nodes array<binary>, parts array<string>"
)


def segments(conversations: DataFrame) -> DataFrame:
    """Conversations' formatted turns with their nodes, read in order and cut into segments."""
    bound_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")

    def gather(batches):
        now = None
        for pdf in batches:
            out = []
            for conv_id, role, text in zip(_ids(pdf["conv_id"]), pdf["role"], pdf["text"], strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None and now.nodes:
                        out.append(now.row())
                    now = _Conversation(conv_id)
                elif now.full():
                    out.append(now.row())
                now.add(role, text)
            yield _frame(out, SEGMENTS)
        if now is not None and now.nodes:
            yield _frame([now.row()], SEGMENTS)

    return ordered.mapInPandas(gather, SEGMENTS)


def _ids(column: pd.Series) -> list:
    return [None if pd.isna(x) else int(x) for x in column.tolist()]


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [column.split()[0] for column in schema.split(", ")]
    return pd.DataFrame({n: pd.Series([r[i] for r in rows], dtype=object) for i, n in enumerate(names)})


class _Pack:
    """A pack being written: its nodes on the path to the conversation before, and what it holds."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.size = 0
        self.nodes: list[dict] = []
        self.conversations: list[dict] = []
        self.path: list[tuple[bytes, int]] = []  # node and its number in the pack
        self.held = 0

    def full(self) -> bool:
        return self.size > PACK or self.held >= HELD

    def add(self, conv_id, segment: int, position: int, nodes: list[bytes], parts: list[str]) -> None:
        shared = 0
        while shared < min(len(nodes), len(self.path)) and self.path[shared][0] == nodes[shared]:
            position += len(parts[shared])
            shared += 1
        known, own_id = conv_id is not None, 0 if conv_id is None else conv_id
        if self.conversations and shared == len(nodes) == len(self.path) and self.conversations[-1]["known"] == known:
            self.conversations[-1]["ids"].append(own_id)
            self.held += 1
            return
        self.path = self.path[:shared]
        for node, part in zip(nodes[shared:], parts[shared:], strict=True):
            parent = self.path[-1][1] if self.path else -1
            self.nodes.append(
                {"begin": self.size, "end": self.size + len(part), "position": position, "parent": parent}
            )
            self.path.append((node, len(self.nodes) - 1))
            self.text.append(part)
            self.size += len(part)
            position += len(part)
        own: list[list[int]] = []
        for _, number in self.path:
            at = self.nodes[number]
            if own and own[-1][1] == at["begin"]:
                own[-1][1] = at["end"]
            else:
                own.append([at["begin"], at["end"]])
        self.conversations.append(
            {
                "ids": [own_id],
                "known": known,
                "segment": segment,
                "intervals": [{"begin": a, "end": b} for a, b in own],
            }
        )
        self.held += 1 + len(own)

    def row(self) -> tuple:
        first = self.conversations[0]
        name = f"{first['ids'][0] if first['known'] else 'null'}:{first['segment']}"
        return (name, "".join(self.text), self.nodes, self.conversations)


def packs(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """The conversations as packs of prefix trees, see the module's text."""
    cut = segments(conversations)
    spark = conversations.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The node that a segment goes on from and its path are the depth-first order; the id splits a path in common.
    order = ("key", "conv_id", "segment")
    dealt = cut.repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    def write(batches):
        pack, root = _Pack(), None
        for pdf in batches:
            out = []
            rows = zip(
                _ids(pdf["conv_id"]), pdf["segment"], pdf["position"], pdf["above"], pdf["nodes"], pdf["parts"], strict=True
            )
            for conv_id, segment, position, above, nodes, parts in rows:
                nodes = [bytes(n) for n in nodes]
                tree = (int(segment), bytes(above) or nodes[0])
                if pack.conversations and (pack.full() or tree != root):
                    out.append(pack.row())
                    pack = _Pack()
                root = tree
                pack.add(conv_id, int(segment), int(position), nodes, list(parts))
            yield _frame(out, COLUMNS)
        if pack.conversations:
            yield _frame([pack.row()], COLUMNS)

    return _with_above(write_table(dealt.mapInPandas(write, PACKS), "packs"))


COLUMNS = "pack string, text string, nodes string, conversations string"


def _with_above(made: DataFrame) -> DataFrame:
    """The packs with ``above``: the pack that holds the segment before that of the conversation that names each."""
    first = F.col("conversations")[0]
    deep = first["segment"] > 0
    own = made.where(deep).select(
        F.col("pack").alias("_pack"),
        first["known"].alias("known"),
        first["ids"][0].alias("conv_id"),
        (first["segment"] - 1).alias("segment"),
    )
    held = made.select("pack", F.explode("conversations").alias("c")).select(
        "pack", "c.known", "c.segment", "c.intervals", F.explode("c.ids").alias("conv_id")
    )
    # A conversation's segment is in one pack and names at most one, so this is row to row.
    led = own.join(held, ["known", "conv_id", "segment"]).select(
        F.col("_pack").alias("pack"), F.struct("pack", "intervals").alias("above")
    )
    shallow = made.where(~deep).withColumn("above", F.lit(None).cast(ABOVE))
    return shallow.unionByName(made.where(deep).join(led, "pack"))


def lineage(above: dict[str, dict | None], pack: str) -> list[dict]:
    """The references that lead up to a pack, the first segment's first; ``above`` holds those of its tree's packs."""
    found = []
    while (now := above[pack]) is not None:
        found.append(now)
        pack = now["pack"]
    return found[::-1]


def unpacked(packed: DataFrame) -> DataFrame:
    """The formatted text of every conversation's segment, cut out of its pack by its intervals."""
    schema = "conv_id bigint, segment int, formatted string"

    def cut(batches):
        for pdf in batches:
            out, size = [], 0
            for text, held in zip(pdf["text"], pdf["conversations"], strict=True):
                for c in held:
                    own = "".join(text[i["begin"] : i["end"]] for i in c["intervals"])
                    for conv_id in c["ids"]:
                        out.append((int(conv_id) if c["known"] else None, c["segment"], own))
                        size += len(own)
                        if size > CUT_CHARS:
                            yield _frame(out, schema)
                            out, size = [], 0
            yield _frame(out, schema)

    return packed.select("text", "conversations").mapInPandas(cut, schema)


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def digests(packed: DataFrame) -> DataFrame:
    """What the packs say of each conversation, its segments read in order."""
    ordered = unpacked(packed).repartition("conv_id").sortWithinPartitions("conv_id", "segment")

    def read(batches) -> Iterator[pd.DataFrame]:
        now, state = (), None

        def closed():
            return (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for pdf in batches:
            out = []
            for conv_id, formatted in zip(_ids(pdf["conv_id"]), pdf["formatted"], strict=True):
                if now != (conv_id,):
                    if state is not None:
                        out.append(closed())
                    now, state = (conv_id,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, begin, end in turns(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if role == LEARN:
                        learnt = unescape(formatted[begin:end])
                        state[2] += len(learnt)
                        state[3].update(learnt.encode("utf-8", "surrogatepass"))
                state[4] += len(formatted)
            yield _frame(out, DIGESTS)
        if state is not None:
            yield _frame([closed()], DIGESTS)

    return ordered.mapInPandas(read, DIGESTS)


def loss_mask(formatted: str) -> np.ndarray:
    """Which characters of a formatted conversation are learnt: the assistant's texts."""
    mask = np.zeros(len(formatted), dtype=bool)
    for role, _, begin, end in turns(formatted):
        mask[begin:end] = role == LEARN
    return mask

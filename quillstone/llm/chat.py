"""Chat formatting by a prefix tree.

Conversations that share initial turns share the nodes of those turns. Every conversation gets a path: a chain of hashes, one a
turn, each over all turns up to there. Sorted by (path, conv_id) over range partitions, conversations that share a beginning are
neighbours, and the order is a depth-first walk of the tree: what a conversation shares with the one before it is
already there, so only its new turns are emitted. Ranges split anywhere, also inside a group of equal conversations or
of one common first turn, so no group meets in one task.

Output: packs, one row each, that stand alone as training sequences: the emitted token ids, the nodes (start and end among the ids,
parent, position id of the first token, the tokens under the loss mask, the ancestors' intervals that the node attends to, contiguous ones
merged) and the leaves (conv_id, node). Tokens are those of a byte-level vocabulary, so the ids give the text back; marks and texts are
encoded apart, so that the mask ends at token borders. A pack is closed before it outgrows PACK_TOKENS or PACK_LEAVES; the next one emits
the open conversation's turns anew, since attention does not reach out of a pack. A longer conversation has a pack of its own.

Template: `[INST] user [/INST]`, `assistant</s>`, `<<SYS>> system <</SYS>>`, `<|role|>text<|end|>` for any other role, `<s>` in
front. Inside texts and roles a backslash is doubled and one is put behind the first letter of a control string, so none is left
there and the escape can be undone.

Defined results: a null text or role is empty; rows of one conversation are sorted by turn (null first), role and text, and repeated
rows are repeated turns; a row of a null conv_id belongs to no other, so it is a conversation of its own; a very large conv_id stays as it is;
long conversations and texts are formatted whole, in time that grows with their length; an empty table gives no packs; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokencount import counter, default_path, default_pattern

PACK_TOKENS, PACK_LEAVES = 1 << 17, 4096
HASH = 32

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>")
START = "<s>"
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("", "</s>"), "system": ("<<SYS>> ", " <</SYS>>")}
OTHER_END = "<|end|>"
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for c in CONTROLS:
        if c in text:
            text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def segment(role: str, text: str, first: bool) -> tuple[str, str, str]:
    """What stands before, in and behind a formatted turn; START comes before the first one."""
    before, after = MARKS.get(role) or (f"<|{escape(role)}|>", OTHER_END)
    return (START if first else "") + before, escape(text), after


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    at, turns = len(START) if formatted.startswith(START) else 0, []
    while at < len(formatted):
        for role in ("user", "system"):
            before, after = MARKS[role]
            if formatted.startswith(before, at):
                break
        else:
            if formatted.startswith("<|", at):
                end = formatted.index("|>", at)
                role, at = unescape(formatted[at + 2 : end]), end
                before, after = "|>", OTHER_END
            else:
                role, (before, after) = "assistant", MARKS["assistant"]
        end = formatted.index(after, at + len(before))
        turns.append((role, unescape(formatted[at + len(before) : end])))
        at = end + len(after)
    return turns


class Pack:
    """One pack as it grows, conversation by conversation in path order."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.nodes: list[dict] = []
        self.leaves: list[dict] = []
        self.open: list[tuple[str, int]] = []  # (path hash, node) along the last conversation

    def shared(self, hashes: list[str]) -> int:
        n = 0
        for (mine, _), other in zip(self.open, hashes):
            if mine != other:
                break
            n += 1
        return n

    def add(self, conv_id: int | None, hashes: list[str], new: list[tuple[list[int], int, int]]) -> None:
        """Add a conversation of which new, (ids, loss start, loss end) a turn, is not open yet."""
        del self.open[len(hashes) - len(new) :]
        for h, (ids, a, b) in zip(hashes[len(hashes) - len(new) :], new):
            parent = self.open[-1][1] if self.open else -1
            start, position, attends = len(self.ids), 0, []
            if parent >= 0:
                up = self.nodes[parent]
                position = up["position"] + up["end"] - up["start"]
                attends = up["attends"]
                if attends and attends[-1][1] == up["start"]:
                    attends = attends[:-1] + [(attends[-1][0], up["end"])]
                else:
                    attends = attends + [(up["start"], up["end"])]
            loss = (start + a, start + b) if b > a else (start, start)
            self.nodes.append({"start": start, "end": start + len(ids), "parent": parent, "position": position, "loss_start": loss[0], "loss_end": loss[1], "attends": attends})
            self.ids += ids
            self.open.append((h, len(self.nodes) - 1))
        self.leaves.append({"conv_id": conv_id, "node": self.open[-1][1]})

    def row(self, name: str) -> dict:
        nodes = [n | {"attends": [{"start": a, "end": b} for a, b in n["attends"]]} for n in self.nodes]
        return {"pack": name, "ids": self.ids, "nodes": nodes, "leaves": self.leaves}


PACK_SCHEMA = (
    "pack string, ids array<int>, nodes array<struct<start: int, end: int, parent: int, position: int, loss_start: int, loss_end: int, attends: array<struct<start: int, end: int>>>>, "
    "leaves array<struct<conv_id: bigint, node: int>>"
)


def chain(roles: list[str], texts: list[str]) -> str:
    """One hash a turn, each over all turns up to there."""
    so_far, out = hashlib.md5(usedforsecurity=False), []
    for role, text in zip(roles, texts):
        raw = role.encode()
        so_far.update(b"%d:%d:" % (len(raw), len(text)) + raw + text.encode())
        out.append(so_far.copy().hexdigest())
    return "".join(out)


def conversations_by_path(turns: DataFrame) -> DataFrame:
    """conv_id (as text: numbers beside nulls would turn to floats in Python), path, roles, texts and tie of each conversation of turns.

    tie tells rows without a conv_id apart, so that many equal ones spread over ranges.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    named = turns.where(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("string").alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    single = turns.where(F.col("conv_id").isNull()).select(F.lit(None).cast("string").alias("conv_id"), F.array(row).alias("turns"), F.monotonically_increasing_id().alias("tie"))
    whole = named.withColumn("tie", F.lit(0).cast("long")).unionByName(single)

    @F.pandas_udf("string")
    def path(roles: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([chain(r, t) for r, t in zip(roles, texts)], dtype=object)

    split = whole.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"), "tie")
    return split.select("conv_id", path("roles", "texts").alias("path"), "roles", "texts", "tie")


def pack(turns: DataFrame, pack_tokens: int = PACK_TOKENS, pack_leaves: int = PACK_LEAVES, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """The packs of all conversations (conv_id, turn, role, text); vocabulary and pattern: those of a byte-level tiktoken encoding."""
    vocabulary, pattern = vocabulary or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, name, encode = Pack(), "", counter(vocabulary, pattern).encoding.encode_ordinary

        def encoded(role: str, text: str, first: bool) -> tuple[list[int], int, int]:
            before, body, after = map(encode, segment(role, text, first))
            loss = (len(before), len(before) + len(body)) if role == "assistant" else (0, 0)
            return before + body + after, *loss

        for batch in batches:
            rows = []
            for conv_id, path, roles, texts in zip(batch["conv_id"], batch["path"], batch["roles"], batch["texts"]):
                hashes = [path[i : i + HASH] for i in range(0, len(path), HASH)]
                known = current.shared(hashes)
                new = [encoded(roles[i], texts[i], not i) for i in range(known, len(hashes))]
                if current.leaves and (len(current.ids) + sum(len(ids) for ids, _, _ in new) > pack_tokens or len(current.leaves) >= pack_leaves):
                    rows.append(current.row(name))
                    current = Pack()
                    new = [encoded(roles[i], texts[i], not i) for i in range(known)] + new
                if not current.leaves:
                    name = f"{path[:HASH]}-{conv_id}"
                current.add(None if conv_id is None else int(conv_id), hashes, new)
            if rows:
                yield pd.DataFrame(rows)
        if current.leaves:
            yield pd.DataFrame([current.row(name)])

    ordered = conversations_by_path(turns).repartitionByRange("path", "conv_id", "tie").sortWithinPartitions("path", "conv_id", "tie")
    return ordered.drop("tie").mapInPandas(run, PACK_SCHEMA)


def read_back(packs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each leaf, from the packs alone."""
    vocabulary, pattern = vocabulary or default_path(), pattern or default_pattern()

    def digest(text_of: Callable[[int, int], str], nodes: list, leaf: int) -> tuple:
        own = nodes[leaf]
        formatted = "".join([text_of(s["start"], s["end"]) for s in own["attends"]] + [text_of(own["start"], own["end"])])
        line, n = [], leaf
        while n >= 0:
            line.append(nodes[n])
            n = nodes[n]["parent"]
        loss = "".join(unescape(text_of(n["loss_start"], n["loss_end"])) for n in reversed(line) if n["loss_end"] > n["loss_start"])
        turns = parse(formatted)
        every = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode())
        return len(turns), every.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = counter(vocabulary, pattern).encoding.decode_bytes
        for batch in batches:
            for ids, nodes, leaves in zip(batch["ids"], batch["nodes"], batch["leaves"]):
                ids = list(map(int, ids))
                text_of = lru_cache(maxsize=64)(lambda a, b, ids=ids: decode(ids[a:b]).decode())
                known: dict[int, tuple] = {}
                rows = []
                for leaf in leaves:
                    if leaf["node"] not in known:
                        known[leaf["node"]] = digest(text_of, nodes, leaf["node"])
                    rows.append((leaf["conv_id"], *known[leaf["node"]]))
                yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    as_text = F.transform("leaves", lambda leaf: F.struct(leaf["conv_id"].cast("string").alias("conv_id"), leaf["node"].alias("node")))
    found = packs.select("ids", "nodes", as_text.alias("leaves")).mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return found.withColumn("conv_id", F.col("conv_id").cast("long"))


def op5_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role")))).alias("r"))
    extra = extra.select("conv_id", F.col("r.turn").cast("long").alias("turn"), "r.role", F.lit(hard).alias("text"))
    return read_back(pack(turns.unionByName(extra)))


QUERIES = {"op5_chat_prefix_tree": op5_chat_prefix_tree}
ORACLES: dict[str, str] = {}
ORACLES["op5_chat_prefix_tree"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', NULL
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', NULL),
escaped AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'),
    '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>'), '<|', '<\|'), '|>', '|\>') AS body
  FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(length(body) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 WHEN 'system' THEN 17 ELSE 11 + length(role) END))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id, own
"""

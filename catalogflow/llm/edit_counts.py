"""Token counts that follow edits: a segment tree of pre-tokens per document, re-encoded only where an edit touches.

A text is cut by the tokenizer's own pattern into pre-tokens, which are encoded independently. Leaves hold the signs
and tokens of ``LEAF`` successive pre-tokens, or of as many words with all their pre-tokens, inner nodes the sums below them. An edit re-encodes from the leaf that
holds the third sign before it, as far as the pattern can look ahead, to the first leaf boundary behind the edit at
which the new cutting meets the old one; from there on both agree, since a match depends only on what follows its
start. The new pre-tokens go into the first touched leaf, the others become empty, and sums are updated upwards.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 32
CONTEXT = 3  # signs before an edit whose cutting the edit can change
CACHED = 400_000

# The bytes that a byte-level vocabulary writes as themselves; the others follow from sign 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(SHOWN)))}


class PretokenCounter(dict):
    """Tokens of a pre-token, each distinct one encoded once while it is remembered.

    The pattern must begin a pre-token at every space between two signs that are no white space and keep a space and
    letters together, as those of byte-level tokenizers do: ``spaced`` counts a space and all signs up to the next
    one at once.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        super().__init__()
        self.pattern = regex.compile(pattern)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        cut = self.tokenizer.pre_tokenizer
        plain = self.tokenizer.normalizer is None and isinstance(cut, pre_tokenizers.ByteLevel)
        plain = plain and not cut.add_prefix_space and isinstance(self.tokenizer.model, models.BPE)
        # Without a normalizer the tokens of a pre-token are those of its bytes by the merges alone.
        self.merges = self.tokenizer.model if plain else None
        self.spaced = SpacedCounter(self)

    def encoded(self, piece: str) -> int:
        if self.merges is None:
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return len(self.merges.tokenize(piece.encode().decode("latin-1").translate(BYTE_SIGNS)))

    def __missing__(self, piece: str) -> int:
        n = self.encoded(piece)
        if len(piece) <= 64:
            if len(self) >= CACHED:  # frequent ones are back at once
                self.clear()
            self[piece] = n
        return n

    def tokens(self, text: str) -> int:
        return sum(map(self.__getitem__, self.pattern.findall(text)))


class SpacedCounter(dict):
    """Tokens of a space and the signs behind it, given without the space; -1 where white space meets white space."""

    def __init__(self, pieces: PretokenCounter):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, run: str) -> int:
        if not run or run[0].isspace() or run[-1].isspace():
            n = -1
        elif run.isascii() and run.isalpha():
            n = self.pieces.encoded(" " + run)
        else:
            n = self.pieces.tokens(" " + run)
        if len(run) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[run] = n
        return n


_counters: dict[tuple[str, str], PretokenCounter] = {}


def counter(path: str, pattern: str) -> PretokenCounter:
    if (path, pattern) not in _counters:
        _counters[path, pattern] = PretokenCounter(path, pattern)
    return _counters[path, pattern]


class Tree:
    """Signs and tokens per leaf with their sums; node i has the children 2i and 2i + 1, leaf k is node width + k."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.leaves = len(chars)
        self.width = 1 << max(0, (self.leaves - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), dtype=np.int64)
        self.sums[self.width:self.width + self.leaves, 0] = chars
        self.sums[self.width:self.width + self.leaves, 1] = tokens
        level = self.width
        while level > 1:
            self.sums[level // 2:level] = self.sums[level:2 * level:2] + self.sums[level + 1:2 * level:2]
            level //= 2

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """Leaf that holds a sign, and the position at which it begins; the last leaf for the text's end."""
        node, begin = 1, 0
        position = min(position, int(self.sums[1, 0]) - 1)
        while node < self.width:
            node *= 2
            left = int(self.sums[node, 0])
            if position - begin >= left:
                begin += left
                node += 1
        return node - self.width, begin

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.width + leaf
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def leaf_values(self) -> np.ndarray:
        return self.sums[self.width:self.width + self.leaves]


def build(text: str, count: PretokenCounter) -> Tree:
    if not text:
        return Tree(np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))
    pieces = text.split(" ")
    chars = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1
    chars[0] -= 1
    tokens = np.fromiter(map(count.spaced.__getitem__, pieces), dtype=np.int64, count=len(pieces))
    tokens[0] = -1 if pieces[0][-1:].isspace() else count.tokens(pieces[0])
    if tokens.min() < 0:
        pieces = count.pattern.findall(text)
        chars = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        tokens = np.fromiter(map(count.__getitem__, pieces), dtype=np.int64, count=len(pieces))
    starts = np.arange(0, len(pieces), LEAF)
    return Tree(np.add.reduceat(chars, starts), np.add.reduceat(tokens, starts))


def edit(text: str, tree: Tree, start: int, end: int, new: str, count: PretokenCounter) -> tuple[str, int]:
    """Replace ``text[start:end]`` and mend the tree; the new text and the signs that were encoded again."""
    changed = text[:start] + new + text[end:]
    if not text:
        rebuilt = build(changed, count)
        tree.__init__(rebuilt.leaf_values()[:, 0], rebuilt.leaf_values()[:, 1])
        return changed, len(changed)
    shift = len(new) - (end - start)
    first, begin = tree.leaf_at(max(0, start - CONTEXT))
    leaf, bound = first, begin + int(tree.sums[tree.width + first, 0])
    signs = tokens = 0
    at = begin
    pieces = count.pattern.finditer(changed, begin)
    while True:
        # Move to the first old boundary behind the edit that the new cutting has not passed.
        while leaf + 1 < tree.leaves and (bound < end or bound + shift < at):
            leaf += 1
            bound += int(tree.sums[tree.width + leaf, 0])
        if bound >= end and bound + shift == at and (at > begin or bound + shift == begin):
            break
        piece = next(pieces, None)
        if piece is None:
            break
        at = piece.end()
        signs += at - piece.start()
        tokens += count[piece.group()]
    for k in range(first + 1, leaf + 1):
        tree.set(k, 0, 0)
    tree.set(first, signs, tokens)
    return changed, signs


def edit_all(text: str, tree: Tree, edits: list[dict], count: PretokenCounter) -> tuple[str, int]:
    """Apply edits given in positions of the old text, from the last to the first."""
    signs = 0
    for e in sorted(edits, key=lambda e: (e["start"], e["end"]), reverse=True):
        text, n = edit(text, tree, e["start"], e["end"], e["new"] or "", count)
        signs += n
    return text, signs


EDITS = "array<struct<start:bigint,end:bigint,new:string>>"
TREES = "doc_id long, text string, edits " + EDITS + ", leaf_chars array<int>, leaf_tokens array<int>"
COUNTS = ("doc_id long, n_before long, n_after long, n_edits long, n_chars_encoded long, text string,"
          " leaf_chars array<int>, leaf_tokens array<int>")


def _builder(path: str, pattern: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = counter(path, pattern)
            values = [build(t.as_py() or "", count).leaf_values() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([v[:, 0] for v in values], type=pa.list_(pa.int32())),
                 pa.array([v[:, 1] for v in values], type=pa.list_(pa.int32()))],
                names=["doc_id", "text", "edits", "leaf_chars", "leaf_tokens"])

    return run


def build_trees(docs: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """(doc_id, text, edits, leaf_chars, leaf_tokens) of ``docs``; ``edits`` is passed on, or null if there is none."""
    edits = F.col("edits").cast(EDITS) if "edits" in docs.columns else F.lit(None).cast(EDITS)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), edits.alias("edits"))
    return rows.mapInArrow(_builder(tokenizer, pattern), TREES)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Trees joined with ``edits(doc_id, start, end, new)``; the edits of one document must not overlap."""
    gathered = edits.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "new")).cast(EDITS).alias("edits"))
    return trees.drop("edits").join(gathered, "doc_id", "left").select(
        "doc_id", "text", "edits", "leaf_chars", "leaf_tokens")


def _editor(path: str, pattern: str, whole: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, out = counter(path, pattern), []
            for key, text, edits, chars, tokens in zip(*batch.columns, strict=True):
                tokens_now = tokens.values.to_numpy()
                before = after = int(tokens_now.sum())
                made, signs = edits.as_py() or [], 0
                new_text, leaves = None, None
                if made:
                    tree = Tree(chars.values.to_numpy(), tokens_now)
                    new_text, signs = edit_all(text.as_py(), tree, made, count)
                    after, leaves = tree.total, tree.leaf_values()
                row = [key.as_py(), before, after, len(made), signs]
                if whole:
                    row += [text.as_py() if leaves is None else new_text,
                            chars.as_py() if leaves is None else leaves[:, 0].tolist(),
                            tokens.as_py() if leaves is None else leaves[:, 1].tolist()]
                out.append(row)
            if out:
                names = [f.split()[0] for f in COUNTS.split(", ")][: len(out[0])]
                types = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), types, strict=False)], names=names)

    return run


def apply_edits(trees: DataFrame, tokenizer: str, pattern: str, whole: bool = True) -> DataFrame:
    """Apply the edits that ``trees`` carry: counts before and after, and with ``whole`` the new texts and trees.

    Null and empty texts have one empty leaf and no tokens. Edits are given in signs of the old text and must not
    overlap; a null replacement removes. Rows given twice are edited twice. An empty table gives no rows.
    """
    schema = COUNTS if whole else ", ".join(COUNTS.split(", ")[:5])
    return trees.mapInArrow(_editor(tokenizer, pattern, whole), schema)


def redactions(text: Column) -> Column:
    """Edits that replace the personal data of a text by the name of its kind; overlaps go to the earlier span."""
    from catalogflow.llm.pii import base_spans

    state = F.struct(F.lit(0).cast("bigint").alias("free"), F.array().cast(EDITS).alias("edits"))
    return F.aggregate(base_spans(text), state, lambda s, p: F.when(p["start"] >= s["free"], F.struct(
        p["end"].alias("free"), F.concat(s["edits"], F.array(F.struct(
            p["start"].alias("start"), p["end"].alias("end"), F.concat(F.lit("<"), p["kind"], F.lit(">")).alias("new")))
        ).alias("edits"))).otherwise(s), lambda s: s["edits"])

"""Exact token counts of every prefix of a text, by prefix dynamic programming.

The ids of a byte-pair encoding have a local test: a sequence of tokens is the
encoding of its bytes exactly if every two neighbours are the encoding of
theirs.  So the last token of the prefix of ``i`` bytes is the one token ``t``
that ends there and fits the last token of the prefix ``i - len(t)``, and its
count is that prefix's count plus one.  One left-to-right pass over a piece
therefore stores the count of each of its prefixes; nothing is encoded twice.

A text is cut into stretches "white space + word", which no pre-token crosses;
counts inside a stretch do not depend on what is around it, so they are cached
by stretch and added up along the text.  Two cases need care: a prefix that
ends in white space (the run is then one pre-token), and one that ends inside
an English contraction (``'r`` of ``'re`` is two pre-tokens).  Strings of added
special tokens count as the library has them by default: one token each; a
prefix that ends inside such a string holds ordinary text.

- ``token_counts`` gives a text's size and the longest prefix within a limit;
- ``prefix_table`` stores all counts, ``BLOCK`` code points a row, and
  ``tokens_at`` and ``longest_prefixes`` answer questions from that table;
- ``truncated`` cuts texts at their longest prefix within a limit.

Defined results: positions are code points; a null or empty text has no tokens
and no rows in the table; the longest prefix within a limit is the largest
position whose count is within it (counts may fall by a little from one
position to the next); repeated rows are counted each, a null ``doc_id`` is kept
but matches no question; an empty table gives no rows; other columns are not
read (``truncated`` keeps them).  A text costs memory in proportion to its own
length (about 30 bytes a character), a task one text at a time.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import per_worker, shielded
from tradelens.llm.packing import default_vocabulary

#: Code points in a row of the stored table.
BLOCK = 65_536
#: Unicode white space, as the vocabulary's pattern has it.
_WS = "\t-\r \x85\xa0  -     　"
_STRETCH = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_LEADING = re.compile(f"[{_WS}]*")
#: Contractions that the vocabulary's pattern takes as one piece.
_CONTRACTIONS = ("'re", "'ve", "'ll")
#: Letters up to here are letters in every version of Unicode's tables.
_LATIN = "ɏ"
#: Longer stretches are not cached.
_CACHED = 64


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Cache(dict):
    """Counts by stretch.  At ``limit`` entries the cache becomes the old
    generation; what is used again moves back from there."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word: str) -> bytes:
        counts = self.old.get(word)
        if counts is None:
            counts = self.make(word)
        if len(word) <= _CACHED:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[word] = counts
        return counts


class PrefixCounter:
    """Token counts of all prefixes of texts, for a byte-level BPE vocabulary in
    a ``tokenizers`` file."""

    def __init__(self, path: str, limit: int = 150_000):
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = _byte_of_char()
        ids = spec["model"]["vocab"]
        in_bytes = {t: bytes(map(to_byte.__getitem__, t)) for t in ids}
        self.vocab = {in_bytes[t]: i for t, i in ids.items()}
        self.rank = [-1] * (max(ids.values()) + 1)  # of the merge that makes a token; a byte has none
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[int, int] = {}
        for r, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = ids[left], ids[right], ids[left + right]
            self.merges[a << 32 | b] = r
            if made not in self.parts:
                self.parts[made], self.rank[made] = (a, b), r
        self._automaton()
        self.special = [t["content"] for t in spec.get("added_tokens") or [] if t["content"]]
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pieces_re = regex.compile(PATTERN)
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.fitting: dict[int, bool] = {}
        self.piece = _Cache(self._piece, 2 * limit)
        self.first = _Cache(self._stretch, limit // 4)
        self.spaced = _Cache(lambda word: self._stretch(" " + word), limit)
        self.newline = self._stretch("\n")

    def _fits(self, a: int, b: int) -> bool:
        """Whether the encoding of the bytes of ``a`` and ``b`` is those two.

        Undoes merges next to the boundary, the later one first.  A pair that
        met there could have merged if its rank comes before that of the merge
        which took one of the two away; at equal ranks the left one is first.
        """
        bound, fits = len(self.merges) + 1, True
        x, y = a, b
        while True:
            if self.merges.get(x << 32 | y, bound) < bound:
                fits = False
                break
            if self.rank[x] > self.rank[y]:
                bound, x = self.rank[x], self.parts[x][1]
            elif self.rank[y] >= 0:
                bound, y = self.rank[y] + 1, self.parts[y][0]
            else:
                break
        if len(self.fitting) >= 1_000_000:
            self.fitting.clear()
        self.fitting[a << 32 | b] = fits
        return fits

    def _automaton(self) -> None:
        """States are beginnings of tokens; after any bytes the state is the
        longest one that ends them, and ``longest`` the longest token that does."""
        trie, token_at = {}, [-1]
        for token, i in sorted(self.vocab.items(), key=lambda x: len(x[0])):
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in trie:
                    trie[key] = len(token_at)
                    token_at.append(-1)
                node = trie[key]
            token_at[node] = i
        fallback, longest = [0] * len(token_at), token_at[:]
        children: dict[int, list] = {}
        for key, node in trie.items():
            children.setdefault(key >> 8, []).append((key & 255, node))
        level = [node for _, node in children.get(0, [])]
        while level:
            below = []
            for node in level:
                if longest[node] < 0:
                    longest[node] = longest[fallback[node]]
                for byte, child in children.get(node, []):
                    state = fallback[node]
                    while state and state << 8 | byte not in trie:
                        state = fallback[state]
                    fallback[child] = trie.get(state << 8 | byte, 0)
                    below.append(child)
            level = below
        self.steps, self.fallback, self.longest = trie, fallback, longest
        self.size = [0] * len(self.rank)
        self.shorter = [-1] * len(self.rank)  # the longest token that ends a token
        for token, i in self.vocab.items():
            self.size[i] = len(token)
            self.shorter[i] = next((self.vocab[token[k:]] for k in range(1, len(token)) if token[k:] in self.vocab), -1)

    def _step(self, key: int) -> int:
        """The state after a byte that the state has no child for; kept."""
        state, byte, steps = key >> 8, key & 255, self.steps
        while state:
            state = self.fallback[state]
            got = steps.get(state << 8 | byte)
            if got is not None:
                break
        else:
            got = 0
        if len(steps) < 4_000_000:
            steps[key] = got
        return got

    def _piece(self, piece: str) -> array:
        """Counts of a pre-token's prefixes, one per code point."""
        data = piece.encode("utf-8", "surrogatepass")
        steps, longest, size, shorter, fitting = self.steps.get, self.longest, self.size, self.shorter, self.fitting.get
        last, count, state, i = [0], [0], 0, 0
        for byte in data:
            key, i = state << 8 | byte, i + 1
            state = steps(key)
            if state is None:
                state = self._step(key)
            token = longest[state]
            while True:
                j = i - size[token]
                if j == 0:
                    break
                fits = fitting(last[j] << 32 | token)
                if fits or fits is None and self._fits(last[j], token):
                    break
                token = shorter[token]
            last.append(token)
            count.append(count[j] + 1)
        if len(data) == len(piece):
            return array("I", count[1:])
        return array("I", [count[i] for i in range(1, len(count)) if i == len(data) or data[i] & 0xC0 != 0x80])

    def _pieces(self, word: str) -> list[str]:
        if word.isascii() or max(word) <= _LATIN:
            return self.pieces_re.findall(word)
        return [word[a:b] for _, (a, b) in self.split(word)]

    def _stretch(self, stretch: str) -> bytes:
        """Counts of a stretch's prefixes as unsigned 32-bit numbers."""
        word = stretch[1:] if stretch[0] == " " else stretch
        if word and (word.isascii() or max(word) <= _LATIN):  # the usual cases: a word, or one with a mark at its end
            if word.isalpha():
                return self.piece[stretch].tobytes()
            if word[-1] in ".,;:!?" and word[:-1].isalpha():
                counts = self.piece[stretch[:-1]]
                return counts.tobytes() + array("I", [counts[-1] + 1]).tobytes()
        blanks = _LEADING.match(stretch).end()
        out = list(self.piece[stretch[:blanks]]) if blanks else []
        if blanks < len(stretch):
            base, start = 0, blanks
            if blanks:
                # The last blank joins the word; any other white space is a piece of its own.
                joined = stretch[blanks - 1] == " "
                base = out[blanks - 2] if blanks > 1 else 0
                if joined:
                    start -= 1
                else:
                    base += self.piece[stretch[blanks - 1]][-1]
            for piece in self._pieces(stretch[start:]):
                counts = [base + c for c in self.piece[piece]]
                if piece in _CONTRACTIONS:
                    counts[1] = base + 2
                out.extend(counts[blanks - start :] if start < blanks else counts)
                base, start = counts[-1], blanks
        return array("I", out).tobytes()

    def _plain(self, text: str) -> np.ndarray:
        """Counts of all prefixes of a text without special tokens."""
        if " ".join(text.split()) != text.replace("\n", " "):  # other than single blanks and line ends
            parts = list(map(self.first.__getitem__, _STRETCH.findall(text)))
        else:
            parts, spaced = [], self.spaced.__getitem__
            for line in text.split("\n"):
                words = line.split(" ")
                parts.append(self.newline)
                parts.append(self.first[words[0]])
                parts.extend(map(spaced, words[1:]))
            parts = parts[1:]
        local = np.frombuffer(b"".join(parts), np.uint32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        ends = local[np.cumsum(sizes) - 1].astype(np.int64)
        return local + np.repeat(np.cumsum(ends) - ends, sizes)

    def counts(self, text: str) -> np.ndarray:
        """Element ``i``: tokens of the text's first ``i + 1`` code points."""
        if not text:
            return np.zeros(0, np.int64)
        if self.special_re is None or not any(s in text for s in self.special):
            return self._plain(text)
        out, base, at = [], 0, 0
        for found in self.special_re.finditer(text):
            before = self._plain(text[at : found.end() - 1])  # a special string cut short is ordinary text
            whole = before[found.start() - at - 1] if found.start() > at else 0
            out += [base + before, np.asarray([base + whole + 1], np.int64)]
            base, at = base + int(whole) + 1, found.end()
        if at < len(text):
            out.append(base + self._plain(text[at:]))
        return np.concatenate(out)


def _counter(vocabulary: str) -> PrefixCounter:
    return per_worker(f"prefix counter {vocabulary}", lambda: PrefixCounter(vocabulary))


def _within(counts: np.ndarray, limit: int) -> int:
    """The largest prefix whose count is within the limit."""
    if not len(counts) or counts[-1] <= limit:
        return len(counts)
    inside = np.flatnonzero(counts <= limit)
    return int(inside[-1]) + 1 if len(inside) else 0


def _sizes(vocabulary: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for got in batches:
            tokens, within = [], []
            for text in got.column(got.num_columns - 1):
                counts = counter.counts(text.as_py() or "")
                tokens.append(int(counts[-1]) if len(counts) else 0)
                within.append(_within(counts, limit))
            yield pa.RecordBatch.from_arrays(
                [*got.columns[:-1], pa.array(tokens, pa.int64()), pa.array(within, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "prefix_chars"],
            )

    return run


def token_counts(docs: DataFrame, limit: int = 512, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, prefix_chars`` per document;
    ``prefix_chars`` is the longest prefix within ``limit`` tokens."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size, F.col("text").cast("string").alias("text")).mapInArrow(
        _sizes(vocabulary or default_vocabulary(), limit), "doc_id long, n_bytes long, n_tokens long, prefix_chars long"
    )
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "prefix_chars")


def prefix_table(docs: DataFrame, vocabulary: str | None = None, block: int = BLOCK) -> DataFrame:
    """``doc_id, block, first, counts``: element ``i`` (from 0) of ``counts`` is
    the number of tokens of the text's first ``first + i + 1`` code points."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for got in batches:
            for doc, text in zip(got.column(0), got.column(1), strict=True):
                counts = counter.counts(text.as_py() or "")
                for at in range(0, len(counts), block):
                    part = pa.array([counts[at : at + block].astype(np.int32)], pa.list_(pa.int32()))
                    place = [pa.array([x], t) for x, t in ((doc.as_py(), pa.int64()), (at // block, pa.int32()), (at, pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*place, part], ["doc_id", "block", "first", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, block int, first long, counts array<int>")


def tokens_at(prefixes: DataFrame, questions: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_chars, n_tokens``: tokens of the first ``n_chars`` code points,
    for questions ``(doc_id, n_chars)`` from 1 to the text's length (others get
    no row)."""
    asked = questions.select("doc_id", F.col("n_chars").cast("long").alias("n_chars")).where("n_chars > 0")
    asked = asked.withColumn("block", F.expr(f"CAST((n_chars - 1) DIV {block} AS INT)"))
    found = F.try_element_at("counts", (F.col("n_chars") - F.col("first")).cast("int")).cast("long")
    return asked.join(prefixes, ["doc_id", "block"]).select("doc_id", "n_chars", found.alias("n_tokens")).where("n_tokens IS NOT NULL")


def longest_prefixes(prefixes: DataFrame, budgets: DataFrame) -> DataFrame:
    """``doc_id, budget, n_chars``: the longest prefix within ``budget`` tokens,
    for budgets ``(doc_id, budget)`` of documents that have tokens."""
    asked = budgets.select("doc_id", F.col("budget").cast("long").alias("budget")).distinct()
    inside = F.expr("array_max(filter(sequence(1, size(counts)), i -> counts[i - 1] <= budget))")
    ends = asked.join(prefixes, "doc_id").select("doc_id", "budget", (F.col("first") + inside).alias("end"))
    return ends.groupBy("doc_id", "budget").agg(F.coalesce(F.max("end"), F.lit(0)).alias("n_chars"))


@shielded
def truncated(docs: DataFrame, limit: int, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with every text cut at its longest prefix within ``limit`` tokens."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for got in batches:
            at = got.schema.names.index("text")
            cut = [None if t is None else t[: _within(counter.counts(t), limit)] for t in got.column(at).to_pylist()]
            columns = [pa.array(cut, pa.string()) if i == at else c for i, c in enumerate(got.columns)]
            yield pa.RecordBatch.from_arrays(columns, got.schema.names)

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema)

"""Unigram pieces: Viterbi over a double-array trie, byte fallback, white-space markers.

A text is encoded as the sequence of pieces with the largest sum of scores. Spaces are
written as the marker `▁`, one of which is put in front of the text. A character that no
piece starts costs a penalty below the least score and is written as the pieces of its
UTF-8 bytes. Decoding joins the pieces, turns byte runs into characters and markers into
spaces.

The best path is found segment by segment. A place between two characters that stand
next to each other in no piece is crossed by no piece, so the best path of a text is the
best paths of its segments one after the other. Texts are parted before markers and at
line ends. Segments repeat, so each worker keeps those it has met lately.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from jobtide.llm.frames import pick
from jobtide.llm.words import as_strings, slabs

MARK = "▁"
BYTE = re.compile("<0x([0-9A-F]{2})>")
# How far below the least score a character outside all pieces lies.
UNKNOWN_PENALTY = 10.0
# Characters of a segment that is searched together with others, segments of a group, and bytes of
# the texts that are encoded together.
LONGEST, SLAB, SLAB_BYTES = 32, 50_000, 1 << 20


class DoubleArray:
    """A trie over characters in two arrays: the child of `s` by code `c` is base[s] + c if check agrees."""

    def __init__(self, words: dict[str, int]) -> None:
        self.codes = {c: i + 1 for i, c in enumerate(sorted({c for w in words for c in w}))}
        width = len(self.codes) + 2
        nested: dict = {}
        for word, value in words.items():
            node = nested
            for c in word:
                node = node.setdefault(c, {})
            node[""] = value
        self.base, self.check, self.value = array("i", [0]), array("i", [0]), array("i", [-1])
        self._grow(2 * width)
        free = 1
        todo = [(0, nested)]
        while todo:
            state, node = todo.pop()
            self.value[state] = node.get("", -1)
            codes = sorted(self.codes[c] for c in node if c)
            if not codes:
                continue
            while self.check[free] >= 0:
                free += 1
                self._grow(free + width)
            base = max(free - codes[0], 0)
            while True:
                self._grow(base + width)
                if all(self.check[base + c] < 0 for c in codes):
                    break
                base += 1
            self.base[state] = base
            for c in codes:
                self.check[base + c] = state
            todo += [(base + self.codes[c], child) for c, child in node.items() if c]

    def _grow(self, size: int) -> None:
        more = size - len(self.base)
        if more > 0:
            self.base.extend([0] * more)
            self.check.extend([-1] * more)
            self.value.extend([-1] * more)

    def prefixes(self, text: str, start: int) -> list[tuple[int, int]]:
        """(end, value) of every word that starts at a place of the text, shortest first."""
        found, state = [], 0
        codes, base, check, value = self.codes, self.base, self.check, self.value
        for end in range(start, len(text)):
            code = codes.get(text[end])
            if code is None:
                break
            child = base[state] + code
            if check[child] != state:
                break
            state = child
            if value[state] >= 0:
                found.append((end + 1, value[state]))
        return found


class PieceModel:
    """The pieces of a model file with their scores."""

    def __init__(self, path: str, limit: int = 100_000) -> None:
        import sentencepiece as spm

        reader = spm.SentencePieceProcessor(model_file=path)
        self.names = [reader.id_to_piece(i) for i in range(reader.get_piece_size())]
        self.scores = [reader.get_score(i) for i in range(len(self.names))]
        self.unknown = reader.unk_id()
        self.bytes = {}
        plain: dict[str, int] = {}
        for i, name in enumerate(self.names):
            if reader.is_byte(i):
                self.bytes[int(BYTE.fullmatch(name)[1], 16)] = i
            elif not (reader.is_unknown(i) or reader.is_control(i) or reader.is_unused(i)):
                plain[name] = i
        self.trie = DoubleArray(plain)
        self.worst = min(self.scores[i] for i in plain.values()) - UNKNOWN_PENALTY
        self.as_bytes = [name.encode() for name in self.names]
        for byte, i in self.bytes.items():
            self.as_bytes[i] = bytes([byte])
        joined = {a + b for name in plain for a, b in zip(name, name[1:])}
        # Markers inside a piece stand behind markers only, and line ends in none: these are the places to part.
        if any(pair[1] == MARK != pair[0] or "\n" in pair for pair in joined):
            self.segments = re.compile("(?s).+")
        else:
            self.segments = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
        # What was met lately, and before; the older half goes when the newer one is full.
        self.kept: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.limit = limit
        self.base, self.check, self.value = (
            np.frombuffer(x, np.int32) for x in (self.trie.base, self.trie.check, self.trie.value)
        )
        self.weights = np.array(self.scores)

    def best(self, text: str) -> list[int]:
        """Ids of the best path; of equal sums, the one whose last differing piece is longer."""
        n = len(text)
        score, back = [0.0] + [float("-inf")] * n, [(0, 0)] * (n + 1)
        scores, worst = self.scores, self.worst
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        codes = list(map(self.trie.codes.get, text))
        for start in range(n):
            here = score[start]
            state, end = 0, start
            single = False
            for code in codes[start:]:
                if code is None:
                    break
                child = base[state] + code
                if check[child] != state:
                    break
                state = child
                end += 1
                piece = value[state]
                if piece >= 0:
                    single = single or end == start + 1
                    total = here + scores[piece]
                    if total > score[end]:
                        score[end], back[end] = total, (start, piece)
            if not single and here + worst > score[start + 1]:
                score[start + 1], back[start + 1] = here + worst, (start, -1)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            elif self.bytes:
                raw = text[start:at].encode("utf-8", "surrogatepass")
                ids.extend(self.bytes[b] for b in reversed(raw))
            else:
                ids.append(self.unknown)
            at = start
        return ids[::-1]

    def best_of_many(self, words: list[str]) -> dict[str, str]:
        """`best` of many short segments at once, one character for each id.

        The search moves over all segments together: for each start and each further
        character one step through the trie's arrays.
        """
        words = sorted(words, key=len, reverse=True)
        sizes = np.array([len(w) for w in words])
        n, width = len(words), int(sizes[0])
        flat = np.fromiter(
            (self.trie.codes.get(c, 0) for c in "".join(words)), np.int32, int(sizes.sum())
        )
        codes = np.zeros((n, width), np.int32)
        codes[np.arange(width) < sizes[:, None]] = flat
        score = np.full((n, width + 1), -np.inf)
        score[:, 0] = 0.0
        length, piece = np.ones((n, width + 1), np.int8), np.full((n, width + 1), -1, np.int32)
        for start in range(width):
            rows = np.arange(np.searchsorted(-sizes, -start))  # longer than start
            here = score[: len(rows), start]
            unknown = np.ones(len(rows), bool)
            state = np.zeros(len(rows), np.int32)
            for end in range(start + 1, width + 1):
                code = codes[rows, end - 1]
                child = self.base[state] + code
                good = (code > 0) & (self.check[child] == state)
                rows, state = rows[good], child[good]
                if not len(rows):
                    break
                found = self.value[state]
                held = found >= 0
                own, found = rows[held], found[held]
                total = here[own] + self.weights[found]
                more = total > score[own, end]
                own = own[more]
                score[own, end], piece[own, end], length[own, end] = total[more], found[more], end - start
                if end == start + 1:
                    unknown[rows[held]] = False
            total = here + self.worst
            own = np.flatnonzero(unknown & (total > score[: len(unknown), start + 1]))
            score[own, start + 1], piece[own, start + 1], length[own, start + 1] = total[own], -1, 1
        # Back from the ends; ids of a row stand in reverse.
        out = np.full((n, width), -2, np.int32)
        at, rows, step = sizes.copy(), np.arange(n), 0
        while len(rows):
            out[rows, width - 1 - step] = piece[rows, at[rows]]
            at[rows] -= length[rows, at[rows]]
            rows = rows[at[rows] > 0]
            step += 1
        odd = (out == -1).any(axis=1)
        held = out >= 0
        joined = out[held].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        ends = np.cumsum(held.sum(axis=1)).tolist()
        ids = {w: joined[a:b] for w, a, b in zip(words, [0, *ends], ends)}
        for i in np.flatnonzero(odd).tolist():
            ids[words[i]] = "".join(map(chr, self.best(words[i])))
        return ids

    def learn(self, words: set[str]) -> None:
        """Have the ids of all these segments at hand."""
        if len(self.kept) >= self.limit:
            self.older, self.kept = self.kept, {}
        fresh = []
        for word in words - self.kept.keys():
            known = self.older.get(word)
            if known is not None:
                self.kept[word] = known
            elif len(word) <= LONGEST:
                fresh.append(word)
            else:
                self.kept[word] = "".join(map(chr, self.best(word)))
        if fresh:
            self.kept.update(self.best_of_many(fresh))

    def encode_many(self, texts: list[str | None]) -> list[str]:
        """Whole texts' ids, one character each; null and empty texts have none."""
        out: list[str] = []
        parts: list[list[str]] = []
        size = 0
        for i, text in enumerate(texts):
            own = self.segments.findall(MARK + text.replace(" ", MARK)) if text else []
            parts.append(own)
            size += len(own)
            if size >= SLAB or i == len(texts) - 1:
                self.learn(set().union(*parts))
                lookup = self.kept.__getitem__
                out += ["".join(map(lookup, own)) for own in parts]
                parts, size = [], 0
        return out

    def encode(self, text: str) -> str:
        """A whole text's ids."""
        return self.encode_many([text])[0]

    def decode(self, ids: str) -> str:
        """The text of ids: byte runs are joined, markers become spaces, the first marker goes.

        Bytes that are no UTF-8 become replacement characters.
        """
        raw = b"".join([self.as_bytes[ord(i)] for i in ids])
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """This worker's model."""
    return PieceModel(path)


def public_pieces(name: str = "piece_bpe_32k.model") -> str:
    """Place of a public model on this machine; every executor resolves its own."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_pieces(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Encode the whole texts of `docs` (doc_id, text): doc_id, n_byte_pieces, ids.

    ids: little-endian unsigned 32-bit integers as binary; n_byte_pieces counts those from
    byte fallback. Null and empty texts have no ids. Null doc_ids stay null, repeated rows
    are encoded each, an empty table gives no rows. Other columns are left out. Texts are
    encoded in slabs of bounded bytes; a longer text is one slab.
    """
    return _coded(docs, model, False)


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """`encode_pieces` with a further column `decoded`, the text that the ids give back.

    It is decoded from the stored form of the ids alone, by the worker that has encoded them.
    Null and empty texts give an empty one.
    """
    return _coded(docs, model, True)


def _coded(docs: DataFrame, model: str | None, back: bool) -> DataFrame:
    names = ["doc_id", "n_byte_pieces", "ids"] + ["decoded"] * back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model or public_pieces())
        drop = {i: None for i in pieces.bytes.values()}
        for batch in batches:
            texts = as_strings(batch.column(1))
            for start, end, _, _ in slabs(texts, SLAB_BYTES):
                ids = pieces.encode_many(texts.slice(start, end - start).to_pylist())
                n_bytes = pa.array([len(i) - len(i.translate(drop)) for i in ids], pa.int64())
                raw = pa.array([i.encode("utf-32-le", "surrogatepass") for i in ids], pa.binary())
                columns = [batch.column(0).slice(start, end - start), n_bytes, raw]
                del ids
                if back:
                    columns.append(
                        pa.array([pieces.decode(i.as_py().decode("utf-32-le", "surrogatepass")) for i in raw], pa.string())
                    )
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_byte_pieces long, ids binary" + ", decoded string" * back
    return pick(docs, doc_id="long", text="string").mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null and empty ids give an empty text.

    Null doc_ids stay null, repeated rows are decoded each, an empty table gives no rows, other
    columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model or public_pieces())
        for batch in batches:
            texts = [
                pieces.decode((raw or b"").decode("utf-32-le", "surrogatepass"))
                for raw in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return pick(encoded, doc_id="long", ids="binary").mapInArrow(run, "doc_id long, text string")

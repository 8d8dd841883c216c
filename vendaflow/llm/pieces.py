"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies."""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from vendaflow.llm.common import column, text_or_empty

SPACE = "▁"
ROWS = 128  # texts that are encoded, checked and handed on together
CACHED = 250_000  # segments a worker remembers; a second set of as many is the one before
LONGEST_CACHED = 40  # characters
CHECKED = 2000  # new segments that go to the library at once
SCANNED = 24  # characters up to which searching a list beats a heap
WORD = re.compile(f"{SPACE}[^{SPACE}\n]+$").match  # one space and a word
NEVER = 1 << 40  # place of a pair that is no piece


class MergeVocabulary:
    """Encoder and decoder for one vocabulary file, with the library beside it as a check.

    A text is cut where no merge can reach across: before a run of spaces if no piece has a
    space behind another character, and around line ends if no longer piece holds one.
    Each segment is merged by an agenda of adjacent symbol pairs, the best score first and
    of equal scores the leftmost. Segments that are not remembered are encoded by the library
    too, batch by batch; a difference is an error.
    """

    def __init__(self, path: str):
        lib = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        self.shown = [piece.replace(SPACE, " ") for piece in self.pieces]
        self.printed = [str(i) for i in range(len(self.pieces))]
        whole = range(len(self.pieces))
        self.byte_of = {i: int(self.pieces[i][1:-1], 16) for i in whole if lib.is_byte(i)}
        self.bytes = {b: i for i, b in self.byte_of.items()}
        self.unknown = lib.unk_id()
        special = (lib.is_unknown, lib.is_control, lib.is_byte, lib.is_unused)
        plain = [i for i in whole if not any(kind(i) for kind in special)]
        self.id_of = {self.pieces[i]: i for i in plain}
        scores = sorted({lib.get_score(i) for i in plain}, reverse=True)
        place = {score: k for k, score in enumerate(scores)}
        # Place of each longer piece in the order of scores: equal scores share a place.
        self.place = {self.pieces[i]: place[lib.get_score(i)] for i in plain if len(self.pieces[i]) > 1}
        apart = not any(SPACE in p.lstrip(SPACE) for p in self.place)
        lines = not any("\n" in p for p in self.place)
        self.words = apart and lines
        if self.words:
            self.cut = re.compile(f"\n[^{SPACE}\n]*|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        elif apart:
            self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            self.cut = re.compile(r".+", re.S)
        # Ids joined by commas, by segment, or by the word if the segment is a space and a word.
        self.recent: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.altered: dict[str, str] = {}  # segments that do not decode to themselves
        self.unchecked: list[tuple[str, list[int]]] = []  # segment, ids
        self.decoded: list[str] = []  # the texts of these ids

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment, whose spaces are already SPACE."""
        if len(segment) <= SCANNED:
            symbols = self.scan(segment)
        else:
            symbols = self.agenda(segment)
        ids = list(map(self.id_of.get, symbols))
        if None not in ids:
            return ids
        ids = []
        for symbol in symbols:
            found = self.id_of.get(symbol)
            if found is not None:
                ids.append(found)
            elif self.bytes:
                ids += [self.bytes[b] for b in symbol.encode()]
            else:
                ids.append(self.unknown)
        return ids

    def scan(self, segment: str) -> list[str]:
        """Merged symbols of a short segment: its agenda is a list searched for the best pair."""
        place = self.place.get
        symbols = [*segment, ""]  # the empty symbol at the end makes no pair
        agenda = [place(segment[i : i + 2], NEVER) for i in range(len(segment) - 1)]
        agenda.append(NEVER)
        while True:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            joined = symbols[i] + symbols.pop(i + 1)
            symbols[i] = joined
            del agenda[i]
            after = symbols[i + 1]
            agenda[i] = place(joined + after, NEVER) if after else NEVER
            if i:
                agenda[i - 1] = place(symbols[i - 1] + joined, NEVER)
        symbols.pop()
        return symbols

    def agenda(self, segment: str) -> list[str]:
        """Merged symbols of a long segment: its agenda is a heap."""
        place, n = self.place.get, len(segment)
        symbols: list[str] = list(segment)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # An entry is place * n + position: the best score first, then the leftmost.
        agenda = []
        for i in range(n - 1):
            found = place(segment[i : i + 2])
            if found is not None:
                agenda.append(found * n + i)
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            found, i = divmod(pop(agenda), n)
            left, j = symbols[i], after[i]
            if not left or j >= n:
                continue
            joined = left + symbols[j]
            if place(joined) != found:
                continue  # the symbols have changed since the entry was made
            symbols[i], symbols[j] = joined, ""
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                found = place(joined + symbols[j])
                if found is not None:
                    push(agenda, found * n + i)
            h = before[i]
            if h >= 0:
                found = place(symbols[h] + joined)
                if found is not None:
                    push(agenda, found * n + h)
        return [symbol for symbol in symbols if symbol]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; the space that encoding puts in front of a text stays."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.shown[i] for i in ids])
        out: list[str] = []
        run = bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run = bytearray()
            if i is not None:
                out.append(self.shown[i])
        return "".join(out)

    def remembered(self, key: str) -> str:
        """Ids of a segment, joined by commas; a key without spaces and line ends is a word."""
        found = self.older.get(key)
        if found is None:
            segment = key if not self.words or key[0] == "\n" or SPACE in key else SPACE + key
            ids = self.merge(segment)
            back = self.decode(ids)
            self.unchecked.append((segment, ids))
            self.decoded.append(back)
            if len(self.unchecked) >= CHECKED:
                self.check()
            if back != segment.replace(SPACE, " "):
                self.altered[key] = back
            found = ",".join([self.printed[i] for i in ids])
        if len(key) <= LONGEST_CACHED:
            if len(self.recent) >= CACHED:
                self.older, self.recent = self.recent, {}
            self.recent[key] = found
        return found

    def check(self) -> None:
        """Compare new segments with the library, which puts a space before each text itself
        and takes it away when it decodes."""
        new, self.unchecked = self.unchecked, []
        decoded, self.decoded = self.decoded, []
        spaced = [row for row in new if row[0][0] == SPACE and len(row[0]) > 1]
        others = [row for row in new if row[0][0] != SPACE and self.bytes]
        for had, texts, skipped in (
            (spaced, [row[0][1:] for row in spaced], 0),
            (others, ["\n" + row[0] for row in others], 2),  # the space and the line end
        ):
            for (segment, ids), expected in zip(had, self.library.encode(texts, num_threads=1)):
                if expected[skipped:] != ids:
                    raise ValueError(f"encoding of {segment[:40]!r} differs from the library's")
        if new:
            # Segments hold whole characters, so they decode one behind the other as each alone.
            back = "".join(decoded)
            whole = self.library.decode([i for _, ids in new for i in ids])
            if whole != (back[1:] if new[0][0][0] == SPACE else back):
                raise ValueError(f"decoding of {len(new)} segments differs from the library's")

    def encode(self, text: str) -> tuple[str, int, str]:
        """(ids joined by commas, number of ids, decoded text)."""
        if not text:
            return "", 0, ""
        keys = [""]
        if self.words and SPACE not in text:
            # Each part has one space before it, or starts with a line end.
            keys = text.replace("\n", " \n").split(" ")
        if "" in keys:  # more spaces than one in a row
            segments = self.cut.findall(SPACE + text.replace(" ", SPACE))
            keys = [s[1:] if WORD(s) else s for s in segments] if self.words else segments
        found = list(map(self.recent.get, keys))
        if None in found:
            found = [f or self.remembered(k) for f, k in zip(found, keys)]
        ids = ",".join(found)
        back = text.replace(SPACE, " ")
        if self.altered and not self.altered.keys().isdisjoint(keys):
            back = self.decode([int(i) for i in ids.split(",")])[1:]
        return ids, ids.count(",") + 1, back


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> MergeVocabulary:
    """One per worker process and file."""
    return MergeVocabulary(path)


def encode(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """The rows with `n_tokens`, `ids_text` (decimal ids joined by commas) and `decoded`.

    With `ids` also `ids` as an array<int>. Null texts count as empty: no ids and an empty
    decoded text. No begin or end ids are added. `path` must name the vocabulary file on
    every executor.
    """
    added = "n_tokens bigint, ids_text string, decoded string" + (", ids array<int>" if ids else "")
    names = [c for c in docs.columns if c not in ("n_tokens", "ids_text", "decoded", "ids")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                counts, joined, decoded = [], [], []
                for text in column(batch, "text"):
                    ids_text, n, back = words.encode(text_or_empty(text))
                    counts.append(n)
                    joined.append(ids_text)
                    decoded.append(back)
                words.check()
                arrays = dict(zip(batch.schema.names, batch.columns)) | {
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_text": pa.array(joined, pa.string()),
                    "decoded": pa.array(decoded, pa.string()),
                }
                if ids:
                    every = ",".join(filter(None, joined))
                    numbers = np.fromstring(every, np.int32, sep=",") if every else np.zeros(0, np.int32)
                    ends = np.cumsum([0, *counts], dtype=np.int32)
                    arrays["ids"] = pa.ListArray.from_arrays(ends, numbers)
                yield pa.record_batch(arrays)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, {added}")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    encoded = encode(docs.select("doc_id", "text"), path, ids=False)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

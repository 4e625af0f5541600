"""SentencePiece encoding of merge type by backtracking, and decoding.

Merging always the best pair gives the one sequence of pieces of which all neighbours are
compatible: the two pieces of each pair, put together and merged anew, fall apart in the same
way. So nothing has to be merged over a whole text. An Aho-Corasick automaton finds the longest
piece that starts at a place, or the next shorter one; the longest that is compatible with its left
neighbour is taken; where none is, the place is marked in a bit field as failed, and the neighbour is taken
back for a shorter one. A compatibility check merges two pieces only and is remembered.

No piece continues over the beginning of a run of spaces or over a character that is in no
piece, so a text falls into words there (checked against the vocabulary; otherwise texts are
cut less), and words into parts between two characters that no piece joins. A task remembers
the words and parts it has encoded.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import groupby
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ranklab.llm.common import map_batches, take

SPACE = "▁"
HELD_WORDS, HELD_LETTERS = 300_000, 64      # words that a task remembers, and the longest of them
HELD_PAIRS = 1_000_000                      # compatibility checks that it remembers
NEVER = float("-inf")


class Words(dict):
    """Packed ids of words, by word; what is not there is encoded, part by part where no piece joins the parts."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        packed = self.before.get(word)
        if packed is None:
            parts = self.codec.parts(word)
            if len(parts) > 1:
                packed = b"".join(map(self.__getitem__, parts))
            else:
                ids = self.codec.ids(word)
                packed = pack(f"<{len(ids)}I", *ids)
        if len(word) <= HELD_LETTERS:
            if len(self) >= HELD_WORDS // 2:                # the older half goes, but for what is still in use
                self.before = dict(self)
                self.clear()
            self[word] = packed
        return packed


class Codec:
    """Encoder and decoder of a merge-type model with byte fallback."""

    def __init__(self, model: str):
        import sentencepiece

        known = sentencepiece.SentencePieceProcessor(model_file=model)
        self.bos, self.eos, self.unknown = known.bos_id(), known.eos_id(), known.unk_id()
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [self.unknown] * 256
        self.out: list[bytes] = []
        self.control: set[int] = set()
        for i in range(known.get_piece_size()):
            piece = known.id_to_piece(i)
            shown = piece.replace(SPACE, " ").encode()
            if known.is_byte(i):
                shown = bytes([int(piece[3:5], 16)])
                self.byte[shown[0]] = i
            elif known.is_control(i):
                shown = b""
                self.control.add(i)
            elif known.is_unknown(i):
                shown = " ⁇ ".encode()
            else:
                self.rank[piece], self.id[piece] = known.get_score(i), i
            self.out.append(shown)
        self.bytes_of = {i: b for b, i in enumerate(self.byte) if i != self.unknown}
        self.letters = frozenset(c for piece in self.rank for c in piece)
        self.joined = frozenset(a + b for piece in self.rank for a, b in zip(piece, piece[1:]))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for piece in self.rank.keys() | self.letters:      # a letter without a piece of its own may still take part in merges
            self.automaton.add_word(piece)
        self.automaton.make_automaton()
        self.longest = max(map(len, self.rank), default=1)
        self.compatible: dict[tuple[str, str], bool] = {}
        self.held: dict[str, str] = {}                      # the longest piece on a path; as many as there are paths
        inside = any(a != SPACE and b == SPACE for a, b in self.joined)
        foreign = "".join(map(re.escape, sorted({chr(b) for b in range(128)} - self.letters)))
        self.cut = None if inside else re.compile(
            f"[{foreign}]|{SPACE}*[^{SPACE}{foreign}]+|{SPACE}+" if foreign else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.words = Words(self)

    def merged(self, text: str) -> list[str]:
        """Symbols after all merges, the best piece first, of equal ones the leftmost: for two pieces at a time."""
        rank = self.rank.get
        symbols = list(text)
        ranks = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while ranks and (best := max(ranks)) > NEVER:
            i = ranks.index(best)
            symbols[i:i + 2] = [own := symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(symbols[i - 1] + own, NEVER)
            if i < len(ranks):
                ranks[i] = rank(own + symbols[i + 1], NEVER)
        return symbols

    def _piece(self, path: str) -> str:
        """Longest beginning of a path through the automaton that is a piece which merging makes; a letter at least."""
        own = path
        while len(own) > 1 and (own not in self.rank or len(self.merged(own)) > 1):
            own = own[:-1]
        return self.held.setdefault(path, self.held.setdefault(own, own))

    def _fits(self, pair: tuple[str, str]) -> bool:
        if len(self.compatible) >= HELD_PAIRS:
            self.compatible.clear()
        found = self.compatible[pair] = self.merged(pair[0] + pair[1]) == [*pair]
        return found

    def pieces(self, text: str) -> list[str]:
        """The pieces of a stretch of letters, all of which are in some piece."""
        longest_prefix, held, compatible, most = self.automaton.longest_prefix, self.held, self.compatible, self.longest
        n = len(text)
        failed = bytearray(n // 8 + 1)                      # bit field: places from which the end cannot be reached
        out: list[str] = []
        at, path = 0, None
        while at < n:
            if path is None:
                path = text[at:at + most]
                path = path[:longest_prefix(path)]
            while path:
                piece = held.get(path) or self._piece(path)
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if not out:
                        break
                    pair = out[-1], piece
                    fits = compatible.get(pair)
                    if fits or fits is None and self._fits(pair):
                        break
                path = piece[:-1]                           # the next shorter one
            if path:
                out.append(piece)
                at, path = end, None
            else:                                           # back to the neighbour, for a shorter one
                failed[at >> 3] |= 1 << (at & 7)
                path = out.pop()[:-1]
                at -= len(path) + 1
        return out

    def parts(self, word: str) -> list[str]:
        """The word cut where no piece joins the two characters."""
        joined, out, start = self.joined, [], 0
        for n in range(1, len(word)):
            if word[n - 1:n + 1] not in joined:
                out.append(word[start:n])
                start = n
        out.append(word[start:])
        return out

    def ids(self, part: str) -> list[int]:
        """Ids of a part: one character that no piece holds, or characters of pieces only."""
        if not self.letters.issuperset(part):
            return self._fallback(part)
        ids: list[int] = []
        for piece in self.pieces(part):
            found = self.id.get(piece)
            ids += self._fallback(piece) if found is None else [found]
        return ids

    def _fallback(self, letter: str) -> list[int]:
        return [self.byte[b] for b in letter.encode()]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers, with those for begin and end."""
        inner = b""
        if text:
            marked = SPACE + text.replace(" ", SPACE)
            parts = self.cut.findall(marked) if self.cut else [marked]
            inner = b"".join(map(self.words.__getitem__, parts))
        return pack("<I", self.bos) + inner + pack("<I", self.eos)

    def decode(self, packed: bytes) -> str:
        """The text of packed ids, without the space that encoding puts in front; bytes that are no UTF-8 become U+FFFD each."""
        ids = np.frombuffer(packed, "<u4").tolist()
        while ids and ids[-1] in self.control:
            ids.pop()
        start = next((n for n, i in enumerate(ids) if i not in self.control), len(ids))
        ids = ids[start:]
        if self.control.isdisjoint(ids):
            joined = b"".join(map(self.out.__getitem__, ids)).decode(errors="one_each")
        else:                                               # characters do not go on over a control id
            runs = groupby(ids, self.control.__contains__)
            joined = "".join(b"".join(map(self.out.__getitem__, run)).decode(errors="one_each") for gone, run in runs if not gone)
        lead = ids and ids[0] not in self.bytes_of and ids[0] != self.unknown and joined[:1] == " "
        return joined[1:] if lead else joined


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    """One codec for a model and process."""
    import codecs

    codecs.register_error("one_each", _one_each)
    return Codec(model)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of the whole text as little-endian unsigned 32-bit numbers, begin and end included.

    `model` is the path of a merge-type model with byte fallback, the same on all machines. A
    null text is empty: begin and end only. Repeated rows and null ids each give a row, texts of
    any length are read whole, an empty table gives none; other columns are not read.
    """
    rows = take(docs, doc_id="doc_id", text="text")
    kind = T.StructType([rows.schema["doc_id"]]).add("n_tokens", "long").add("ids", "binary")

    def work(batch: pa.RecordBatch) -> dict:
        own = codec(model)
        ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "n_tokens": [len(i) // 4 for i in ids], "ids": ids}

    return map_batches(rows, work, kind)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """`encoded` (doc_id, n_tokens, ids) with the text of its ids; null ids have a null text."""
    rows = encoded.select("doc_id", "n_tokens", "ids")
    kind = T.StructType([*rows.schema.fields]).add("decoded", "string")

    def work(batch: pa.RecordBatch) -> dict:
        own = codec(model)
        texts = [None if i is None else own.decode(i) for i in batch.column(2).to_pylist()]
        return {"doc_id": batch.column(0), "n_tokens": batch.column(1), "ids": batch.column(2), "decoded": texts}

    return map_batches(rows, work, kind)


def digest(decoded: DataFrame) -> DataFrame:
    """Ids and decoded text as SHA-256."""
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))

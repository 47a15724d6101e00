"""SentencePiece BPE, encoded by backtracking and decoded, for models without a normalizer of their own.

A text's encoding is the only sequence of pieces whose neighbours are compatible: merging the two pieces' characters anew
gives the same two pieces. So the encoder takes the longest piece at each place, found by an Aho-Corasick automaton, checks
it against the piece before, and on failure tries shorter ones; a bit field remembers the places from which no encoding
goes on, so each is left for good at most once and the work is linear in the text.

Texts are cut where no piece can stand across: between two characters that stand side by side in no piece. A worker
remembers a bounded number of such cuts. The model file's path is a parameter; each worker reads it once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Words, cuts and pairs a worker remembers before it starts afresh; bounds its memory, not its results.
REMEMBERED = 1_000_000


_RUNS = re.compile(rf"\n|{SPACE}*\w+|[^\w\n]+")


class PieceModel:
    """The pieces, scores and bytes of a BPE model with byte fallback."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.text: list[str] = []
        self.byte_ids, self.byte_of, self.control = {}, {}, set()
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        for n in range(self.size):
            piece = model.id_to_piece(n)
            self.text.append(piece)
            if model.is_byte(n):
                self.byte_of[n] = int(piece[3:5], 16)
                self.byte_ids[self.byte_of[n]] = n
            elif model.is_control(n) or model.is_unknown(n):
                self.control.add(n)
            else:
                self.scores[piece], self.ids[piece] = model.get_score(n), n
        self.unknown = model.unk_id()
        probe = "  A é  ﬁ"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models that keep a text as it is and add a space before it are supported")
        self.side_by_side = {(a, b) for p in self.scores for a, b in zip(p, p[1:], strict=False)}
        # Characters that stand in pieces but are none themselves take part in merges, and fall back to bytes if left over.
        self.wording = [*self.text, *({c for p in self.scores for c in p} - self.scores.keys())]
        self.number = {p: n for n, p in enumerate(self.wording) if p in self.scores or n >= self.size}
        self.automaton = ahocorasick.Automaton()
        for piece, n in self.number.items():
            if len(piece) == 1 or self.merged(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), n))
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.compatible: dict[int, bool] = {}
        # What each id shows; ids of other bytes, of controls and of the unknown depend on their neighbours or place.
        self.shown = [chr(self.byte_of[n]) if n in self.byte_of else p.replace(SPACE, " ") for n, p in enumerate(self.text)]
        self.not_alone = {n for n, b in self.byte_of.items() if b > 127} | self.control
        self.digits = [str(n) for n in range(self.size)]

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging the best-scored neighbours, leftmost first, until none is left."""
        parts = list(text)
        scores = self.scores
        while len(parts) > 1:
            best, at = None, -1
            for n in range(len(parts) - 1):
                score = scores.get(parts[n] + parts[n + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, n
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether the two pieces may stand side by side: merging their characters anew gives them back."""
        if len(self.compatible) > REMEMBERED:
            self.compatible.clear()
        a, b = self.wording[left], self.wording[right]
        known = self.compatible[left << 32 | right] = (a[-1], b[0]) not in self.side_by_side or self.merged(a + b) == [a, b]
        return known

    def next_shorter(self, piece: int) -> int:
        """The longest other piece that begins this one, or -1."""
        if piece not in self.shorter:
            text = self.wording[piece]
            self.shorter[piece] = next((self.number[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.automaton), -1)
        return self.shorter[piece]

    def backtrack(self, text: str) -> list[int]:
        """The numbers of a text's pieces; a character that stands in none comes alone."""
        longest = [-1] * len(text)
        for end, (length, piece) in self.automaton.iter(text):
            longest[end + 1 - length] = piece  # a later end is a longer piece
        if -1 in longest:
            longest = [p if p >= 0 else self.stranger(c) for p, c in zip(longest, text, strict=True)]
        wording, known = self.wording, self.compatible
        closed, found = 0, []  # closed: a bit field of the places from which no encoding goes on
        at, last, piece, size = 0, -1, longest[0], len(text)
        while at < size:
            while piece >= 0:
                end = at + len(wording[piece])
                if not closed >> end & 1:
                    fits = True if last < 0 else known.get(last << 32 | piece)
                    if fits or fits is None and self.fits(last, piece):
                        break
                piece = self.next_shorter(piece)
            if piece >= 0:
                found.append(piece)
                at, last = end, piece
                piece = longest[at] if at < size else -1
            else:
                closed |= 1 << at
                piece = found.pop()
                at -= len(wording[piece])
                last = found[-1] if found else -1
        return found

    def stranger(self, char: str) -> int:
        """A number for a character that stands in no piece."""
        if char not in self.number:
            self.number[char] = len(self.wording)
            self.wording.append(char)
        return self.number[char]

    def ids_of(self, text: str) -> list[int]:
        """The ids of a text that no piece can cross the ends of."""
        found = self.backtrack(text)
        if max(found) < self.size:
            return found
        return [n for p in found for n in ([p] if p < self.size else self.spelled(self.wording[p]))]

    def spelled(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]

    def cuts(self, text: str) -> list[str]:
        """Parts of a text between which no piece can stand: runs of letters and of other signs, where they may part."""
        parts = _RUNS.findall(text)
        if len(parts) > 1:
            joined = parts[:1]
            for part in parts[1:]:
                if (joined[-1][-1], part[0]) in self.side_by_side:
                    joined[-1] += part
                else:
                    joined.append(part)
            return joined
        return parts

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: bytes joined to characters, wrong ones shown as U+FFFD, one leading space taken away."""
        if ids and self.not_alone.isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
            return text[1:] if ids[0] not in self.byte_of and text[:1] == " " else text
        out, pending, first = [], bytearray(), True
        for n in [*ids, None]:
            if n in self.byte_of:
                pending.append(self.byte_of[n])
                first = False
                continue
            if pending:
                out.append(_characters(bytes(pending)))
                pending = bytearray()
            if n is None or n in self.control and n != self.unknown:
                continue
            piece = " ⁇ " if n == self.unknown else self.text[n].replace(SPACE, " ")
            out.append(piece[1:] if first and n != self.unknown and piece[:1] == " " else piece)
            first = False
        return "".join(out)


def _characters(raw: bytes) -> str:
    """UTF-8 in which each byte that begins no whole character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


class _Words(dict):
    """Ids of words as they stand after a space, or after a line break if the word begins with one."""

    def __init__(self, codec: PieceCodec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> list[int]:
        text = word if word[:1] == "\n" else SPACE + word
        self[word] = known = self.codec.whole(text)
        return known


class _Parts(dict):
    """Ids of short parts."""

    def __init__(self, ids_of: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.ids_of = ids_of

    def __missing__(self, part: str) -> list[int]:
        self[part] = known = self.ids_of(part)
        return known


class PieceCodec:
    """Encoder and decoder of whole texts."""

    def __init__(self, path: str) -> None:
        self.model = PieceModel(path)
        pairs = self.model.side_by_side
        self.apart = not any(b == SPACE and a != SPACE for a, b in pairs) and not any("\n" in p for p in pairs)
        self.parts = _Parts(self.model.ids_of)
        self.words = _Words(self)
        self.runs = re.compile(f"  |^ |{SPACE}").search

    def whole(self, text: str) -> list[int]:
        """The ids of a text in which each space is already its stand-in."""
        parts = self.model.cuts(text)
        if len(parts) == 1:
            return self.model.ids_of(text)
        ids = []
        for part in parts:
            if len(part) > 64:
                ids += self.model.ids_of(part)
            elif part[0] == SPACE and part[1:2].isalpha():
                ids += self.words[part[1:]]
            else:
                ids += self.parts[part]
        return ids

    def encode(self, text: str) -> list[int]:
        """All ids of the text; an empty one has none."""
        if not text:
            return []
        if not self.apart or self.runs(text):
            return self.whole(SPACE + text.replace(" ", SPACE))
        if len(self.words) + len(self.parts) > REMEMBERED:
            self.words.clear()
            self.parts.clear()
        return list(chain.from_iterable(map(self.words.__getitem__, text.replace("\n", " \n").split(" "))))

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@lru_cache(maxsize=2)
def load(path: str) -> PieceCodec:
    """One per worker and file."""
    return PieceCodec(path)


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and the ids of each text as array<int>; a NULL text is empty, and an empty one has no ids."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        encode = load(model).encode
        return pd.Series([encode(t or "") for t in texts], dtype=object)

    return docs.select("doc_id", ids(F.col("text").cast("string")).alias("ids"))


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """doc_id and the text of each row's ids; NULL ids give an empty text."""

    @F.pandas_udf("string")
    def texts(ids: pd.Series) -> pd.Series:
        decode = load(model).decode
        return pd.Series([decode([] if x is None else [int(n) for n in x]) for x in ids], dtype=object)

    return rows.select("doc_id", texts("ids").alias("text"))


def round_trips(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, and digests of each text's ids and of the text that these ids decode to.

    Both are made in one pass, so that ids, several times the text in size, never leave the worker. NULL texts are
    empty; repeated rows come back as often; other columns are ignored.
    """

    @F.pandas_udf("struct<n_tokens:long, ids_sha256:string, decoded_sha256:string>")
    def digests(texts: pd.Series) -> pd.DataFrame:
        codec = load(model)
        digit, rows = codec.model.digits.__getitem__, []
        for text in texts:
            ids = codec.encode(text or "")
            written = ",".join(map(digit, ids))
            rows.append((len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digests(F.col("text").cast("string")).alias("d")).select("doc_id", "d.*")

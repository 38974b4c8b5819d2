"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

A text is escaped as SentencePiece does (a leading space, spaces as U+2581) and cut where no piece can cross: before a
run of spaces, and around line breaks. Each distinct word is segmented once while a worker remembers it. Words of equal
length advance together, one character at a time: rolling hashes of the substrings that end there probe the sorted
hashes of the pieces, and the maximum over them is the best score up to that character, with a pointer back. Ties go to
the longer last piece. A character without a piece costs the least score less `UNKNOWN` and becomes its bytes.

The model file is read with its library; scores are taken as unigram scores, whatever the model was trained as. Decoding
gathers the bytes of the pieces in one step and takes back the leading space.

Edge cases: a null or empty text has no pieces. Runs of spaces, tabs and line breaks round-trip; U+2581 itself
decodes to a space, as in the library, and is reported in `round_trip`. Words of more than `LONG` characters are segmented
one by one. Repeated rows are encoded alike. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slowtide.llm.common import pick, text_bytes
from slowtide.llm.tokens import Encoder, encoded, encoder
from slowtide.session import ship

SPACE = "▁"
UNKNOWN = 10.0
LONG = 256
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Bits of a first look-up that most substrings fail.
_SIEVE = 20
_UNITS = re.compile(rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def hashes(codes: np.ndarray) -> np.ndarray:
    """Rolling hash of a whole array of code points, row by row."""
    h = np.zeros(codes.shape[1], np.uint64)
    for row in codes:
        h = h * _MULTIPLIER + row + np.uint64(1)
    return h


class Pieces:
    """The pieces of a model file, their scores and look-up tables."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(self.size)]
        self.byte = {int(names[i][1:-1], 16): i for i in range(self.size) if model.is_byte(i)}
        self.unknown = model.unk_id()
        normal = [i for i in range(self.size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {names[i]: (model.get_score(i), i) for i in normal}
        self.longest = max(map(len, self.score), default=1)
        self.least = min((s for s, _ in self.score.values()), default=0.0) - UNKNOWN
        keys, scores, ids = [], [], []
        for length in range(1, self.longest + 1):
            same = [n for n in self.score if len(n) == length]
            if same:
                codes = np.frombuffer("".join(same).encode("utf-32-le"), np.uint32).reshape(len(same), length).T.astype(np.uint64)
                keys.append(hashes(codes))
                scores += [self.score[n][0] for n in same]
                ids += [self.score[n][1] for n in same]
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        self.keys, self.scores, self.ids = keys[order], np.array(scores)[order], np.array(ids, np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.sieve = np.zeros(1 << _SIEVE, bool)
        self.sieve[(self.keys * _MIX) >> np.uint64(64 - _SIEVE)] = True
        surface = [bytes([int(n[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.sizes = np.array([len(x) for x in surface], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)

    def probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of each hash; minus infinity and -1 where no piece has it."""
        score, ids = np.full(h.shape, -np.inf), np.full(h.shape, -1, np.int64)
        maybe = np.nonzero(self.sieve[(h * _MIX) >> np.uint64(64 - _SIEVE)])
        some = h[maybe]
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        hit = self.keys[at] == some
        score[tuple(x[hit] for x in maybe)] = self.scores[at[hit]]
        ids[tuple(x[hit] for x in maybe)] = self.ids[at[hit]]
        return score, ids

    def fallback(self, char: str) -> list[int]:
        """The byte pieces of a character, or the unknown piece of a model without them."""
        return [self.byte[b] for b in char.encode()] if self.byte else [self.unknown]

    def batch(self, words: list[str]) -> list[list[int]]:
        """Segment words of one length together."""
        n, many = len(words[0]), len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(many, n).T.astype(np.uint64)
        best = np.zeros((n + 1, many))
        back, piece = np.zeros((n + 1, many), np.int64), np.zeros((n + 1, many), np.int64)
        rolling = np.zeros((0, many), np.uint64)
        columns = np.arange(many)
        for end in range(1, n + 1):
            # one row per start, the longest substring first
            first = max(0, end - self.longest)
            rolling = np.concatenate([rolling[-(end - 1 - first) :] if end - 1 > first else rolling[:0], np.zeros((1, many), np.uint64)])
            rolling = rolling * _MULTIPLIER + (codes[end - 1] + np.uint64(1))
            score, ids = self.probe(rolling)
            lone = ids[-1] < 0
            score[-1, lone] = self.least
            total = best[first:end] + score
            top = total.argmax(axis=0)
            best[end] = total[top, columns]
            back[end] = first + top
            piece[end] = ids[top, columns]
        out: list[list[int]] = [[] for _ in words]
        at = np.full(many, n)
        steps = []
        while (at > 0).any():
            live = np.flatnonzero(at > 0)
            steps.append((live, piece[at[live], live], at[live]))
            at[live] = back[at[live], live]
        for live, ids, ends in reversed(steps):
            for w, i, e in zip(live.tolist(), ids.tolist(), ends.tolist(), strict=True):
                out[w] += [i] if i >= 0 else self.fallback(words[w][e - 1])
        return out

    def single(self, word: str) -> list[int]:
        """The same search over one long word."""
        best, back = [0.0], [(0, -1)]
        for end in range(1, len(word) + 1):
            top, how = -np.inf, (end - 1, -1)
            for start in range(max(0, end - self.longest), end):
                known = self.score.get(word[start:end])
                if known is None and start < end - 1:
                    continue
                score = best[start] + (known[0] if known else self.least)
                if score > top:
                    top, how = score, (start, known[1] if known else -1)
            best.append(top)
            back.append(how)
        out, at = [], len(word)
        while at:
            start, i = back[at]
            out.append([i] if i >= 0 else self.fallback(word[at - 1]))
            at = start
        return [i for part in reversed(out) for i in part]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of texts whose ids end at `ends`, with the leading spaces, and where each text ends."""
        sizes = self.sizes[ids]
        upto = np.cumsum(sizes)
        out = self.bytes[np.repeat(self.starts[ids] - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)]
        return out, np.concatenate([[0], upto])[ends]


class PieceEncoder(Encoder):
    """Remembers words as the other encoder does, and segments new ones with `Pieces`."""

    pattern = rf"^(?P<a>[^{SPACE}\n]+)(?P<b>)(?:\n(?P<c>[^{SPACE}\n]+)(?P<d>))?$"
    lead = head = SPACE

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.size = self.pieces.size
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._forget()

    def _alone(self, stretch: str) -> bool:
        return bool(stretch) and SPACE not in stretch

    def _whole(self, text: str) -> np.ndarray:
        units = _UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []
        return np.array([i for ids in self._encoded(units) for i in ids], self.kind)

    def _encoded(self, parts: list[str]) -> list[list[int]]:
        by_length: dict[int, list[str]] = {}
        for part in dict.fromkeys(parts):
            by_length.setdefault(len(part), []).append(part)
        found = {}
        for length, words in by_length.items():
            made = [self.pieces.single(w) for w in words] if length > LONG else self.pieces.batch(words) if length else [[]]
            found.update(zip(words, made, strict=True))
        return [found[p] for p in parts]


def encode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_pieces, n_bytes (byte pieces), ids_crc32, the decoded text's crc32 and whether it is the text; and ids."""
    ship(docs.sparkSession)
    schema = "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, text_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids

    def rows(batches):
        coder = encoder(path, PieceEncoder)
        pieces, is_byte = coder.pieces, np.zeros(coder.size, bool)
        is_byte[list(pieces.byte.values())] = True
        for batch in batches:
            names, column = batch.column("doc_id"), batch.column("text")
            for start, stop, ids, ends in encoded(column, coder):
                data, offsets = text_bytes(column.slice(start, stop - start))
                texts = data.tobytes()
                spelled, stops = pieces.decode(ids, ends)
                whole, wide, begun, last = spelled.tobytes(), ids.astype("<u4"), 0, 0
                crc, text_crc, same = [], [], []
                for first, after, end, until in zip(offsets[:-1].tolist(), offsets[1:].tolist(), ends.tolist(), stops.tolist(), strict=True):
                    back = whole[last + (until > last and whole[last : last + 1] == b" ") : until]
                    crc.append(zlib.crc32(wide[begun:end]))
                    text_crc.append(zlib.crc32(back))
                    same.append(back == texts[first:after])
                    begun, last = end, until
                columns = [
                    names.slice(start, stop - start), pa.array(np.diff(ends, prepend=0)), pa.array(np.diff(np.concatenate([[0], np.cumsum(is_byte[ids])])[ends], prepend=0)),
                    pa.array(crc, pa.int64()), pa.array(text_crc, pa.int64()), pa.array(same),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(wide.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_pieces", "n_bytes", "ids_crc32", "text_crc32", "round_trip"] + ["ids"] * with_ids)

    return pick(docs, "doc_id", "text").mapInArrow(rows, schema)


def op10_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))

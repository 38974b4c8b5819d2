"""Token ids of whole texts from a public tokenizer file, in bounded memory.

Encoding a text equals encoding its stretches between single spaces, provided the characters beside each such
space are not white space: the tokenizers used here never merge across one. A stretch that is a word with marks
behind it, with at most one line break and a second such word, also falls apart at those places. Arrow splits a
chunk of texts and numbers its distinct stretches and parts; the library sees each distinct part once per worker
while it is remembered; numpy puts the ids of the texts together. A text with other white space beside a space goes
to the library whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts remembered per worker; beyond, those of the last chunk are kept.
REMEMBERED = 1_000_000
#: Bytes of text encoded at once.
CHUNK = 8 << 20
_WORD = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKS = r"[.,!?;:|#*$%&<>]*"


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items `at` of a list laid out flat, end to end, and the end of each."""
    size = sizes[at]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    index = np.repeat(starts[at] - (ends - size), size)
    index += np.arange(total)
    return flat[index], ends


class Encoder:
    """Ids of texts by the tokenizer file at `path`."""

    #: How a stretch falls apart into up to two words with marks, and what goes before the first.
    pattern = rf"^(?P<a>{_WORD})(?P<b>{_MARKS})(?:\n(?P<c>{_WORD})(?P<d>{_MARKS}))?$"
    lead = " "
    head = ""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # a task has one core; the library's own threads would only wait for each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._forget()

    def _forget(self) -> None:
        """Places of the parts (as UTF-8) known so far, their ids end to end, and how many each has. The empty part comes first."""
        self.known, self.flat, self.sizes = {b"": 0}, np.zeros(0, self.kind), np.zeros(1, np.int64)

    def _encoded(self, parts: list[str]) -> list[list[int]]:
        return [f.ids for f in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._encoded([text])[0], self.kind)

    def _alone(self, stretch: str) -> bool:
        """Whether a stretch of no known form may be encoded without its surroundings."""
        return bool(stretch) and not stretch[0].isspace() and not stretch[-1].isspace()

    def _places(self, parts: pa.Array) -> np.ndarray:
        """Where the parts are among the known ones, after learning those that are not."""
        names = parts.cast(pa.binary()).to_pylist()
        # Arrow's index_in would hash all known parts again for every chunk
        new = list(dict.fromkeys(part for part in names if part not in self.known))
        flat, sizes = [self.flat], [self.sizes]
        for at in range(0, len(new), 2048):
            found = self._encoded([part.decode() for part in new[at : at + 2048]])
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            flat.append(np.fromiter(chain.from_iterable(found), self.kind, sizes[-1].sum()))
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.flat, self.sizes = np.concatenate(flat), np.concatenate(sizes)
        places = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        if len(self.known) > REMEMBERED:
            used = np.unique(np.append(places, 0))
            self.flat, _ = gather(self.flat, np.cumsum(self.sizes) - self.sizes, self.sizes, used)
            self.sizes = self.sizes[used]
            places = np.searchsorted(used, places)
            self.known = {b"": 0} | dict(zip(names, places.tolist(), strict=True))
        return places

    def _stretches(self, texts: pa.Array, lead: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct stretches: flat, how many each has, and whether it needs its surroundings."""
        n = len(texts)
        form = pc.extract_regex(texts, self.pattern)
        known = form.is_valid().to_numpy(zero_copy_only=False)
        columns, met, count = np.zeros((n, 5), np.int64), [pa.array(["", "\n"], pa.string())], 2
        rows = np.flatnonzero(known)
        split = form.take(pa.array(rows))
        for column, name in ((0, "a"), (1, "b"), (3, "c"), (4, "d")):
            coded = split.field(name).dictionary_encode()
            columns[rows, column] = coded.indices.to_numpy() + count
            met.append(pc.binary_join_element_wise(lead, coded.dictionary, "") if name == "a" else coded.dictionary)
            count += len(coded.dictionary)
        columns[rows[pc.not_equal(split.field("c"), "").to_numpy(zero_copy_only=False)], 2] = 1
        tied, others = np.zeros(n, bool), []
        for i in np.flatnonzero(~known).tolist():
            stretch = texts[i].as_py()
            tied[i] = not self._alone(stretch)
            if not tied[i]:
                columns[i, 0] = count + len(others)
                others.append(lead + stretch)
        at = self._places(pa.concat_arrays([*met, pa.array(others, pa.string())]))
        own, ends = gather(self.flat, np.cumsum(self.sizes) - self.sizes, self.sizes, at[columns.ravel()])
        return own, np.diff(ends[4::5], prepend=0), tied

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the end of each. No text may be null."""
        n = len(texts)
        if not n:
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        own, sizes, tied = self._stretches(coded.dictionary, self.lead)
        if self.head != self.lead:
            # the first stretch of a text has no space before it
            firsts = at[bounds[:-1] - bounds[0]]
            distinct, back = np.unique(firsts, return_inverse=True)
            more = self._stretches(coded.dictionary.take(pa.array(distinct)), self.head)
            own, sizes, tied = np.concatenate([own, more[0]]), np.concatenate([sizes, more[1]]), np.concatenate([tied, more[2]])
            at = at.copy()
            at[bounds[:-1] - bounds[0]] = back + len(coded.dictionary)
        ids, ends = gather(own, np.cumsum(sizes) - sizes, sizes, at)
        stops = np.concatenate([[0], ends])[bounds[1:] - bounds[0]]
        whole = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(tied[at])])[bounds - bounds[0]]))
        if len(whole):
            starts, made, last = np.concatenate([[0], stops[:-1]]), [], 0
            lengths = stops - starts
            for i in whole.tolist():
                text = self._whole(texts[i].as_py())
                made += [ids[last : starts[i]], text]
                lengths[i], last = len(text), stops[i]
            ids, stops = np.concatenate([*made, ids[last:]]), np.cumsum(lengths)
        return ids, stops


_loaded: dict[tuple, Encoder] = {}


def encoder(path: str, kind: type[Encoder] = Encoder) -> Encoder:
    """The worker's encoder of a file, kept from task to task."""
    if (path, kind) not in _loaded:
        _loaded[path, kind] = kind(path)
    return _loaded[path, kind]


def encoded(column: pa.Array, coder: Encoder, end: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after, ids of the rows end to end, their ends) by bounded chunks, `end` after each row."""
    texts = column.fill_null("") if column.null_count else column
    upto = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(upto, upto[start] + CHUNK, side="right")) - 1)
        ids, ends = coder.encode(texts.slice(start, stop - start))
        if end is not None:
            ids, ends = np.insert(ids, ends, end), ends + np.arange(1, len(ends) + 1)
        yield start, stop, ids, ends
        start = stop

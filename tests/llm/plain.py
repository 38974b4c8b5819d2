"""Plain versions of the operators and awkward inputs, for the tests of this folder."""

from __future__ import annotations

import re
import zlib

import numpy as np
import xxhash

SCHEMA = "DOC_ID string, doc_id long, text string, lang string, kept string, score string, n_words string, Text string"
LONG = "alpha beta gamma delta " * 20_000


def edge_docs(spark):
    """Nulls in every column, empty, blank, tiny and very long texts, repeated rows and clashing columns."""
    rows = [
        ("x", 1, None, "en", "k", "s", "n", "t"),
        (None, 2, "", None, None, None, None, None),
        (None, 3, " \n\t ", "en", None, None, None, None),
        (None, 4, "one", "de", None, None, None, None),
        (None, 5, "one two", "de", None, None, None, None),
        (None, 6, LONG, "en", None, None, None, None),
        (None, 7, "Released under the MIT License.\nunder the mit license cc by-nc", "en", "false", "1", "1", "u"),
        (None, 7, "Released under the MIT License.\nunder the mit license cc by-nc", "en", "false", "1", "1", "u"),
        (None, None, "no id but words that go on for a while " * 5, "fr", None, None, None, None),
        (None, None, None, None, None, None, None, None),
        (None, 8, "12345 !!! ###", "en", None, None, None, None),
        (None, 9, "  two  spaces \n\nand\ttabs\n", "en", None, None, None, None),
        (None, 10, "日本語のテキスト 😀 naïve café", "ja", None, None, None, None),
        (None, 11, " ".join(f"word{chr(97 + i)}" for i in range(26)) + ".", "en", None, None, None, None),
        (None, -3, "the quick brown fox " * 9, "en", None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def documents(spark, name="documents"):
    return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    w = words(text)
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def groups(prints, budget=2):
    """The smallest index in the component of each fingerprint."""
    v = np.array(prints, np.uint64)
    up = list(range(len(v)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= budget) + i + 1:
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(v))]


def base_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    again = {p for starts in seen.values() if len(starts) > 1 for s in starts for p in range(s, s + 8)}
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def encodings(texts, name):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def shingle_set(text, width=5):
    words = (text or "").encode().lower().split()
    width = min(width, len(words)) or 1
    return frozenset(b" ".join(words[k : k + width]) for k in range(len(words) - width + 1)) if words else frozenset()


def similar_groups(texts):
    """The smallest id of each id's component of pairs at a 5-word Jaccard of 0.8 or more; texts without words are alike."""
    ids, sets = sorted(texts), {i: shingle_set(t) for i, t in texts.items()}
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if 5 * len(a & b) >= 4 * len(a | b) if a | b else True:
                low, high = sorted((top(i), top(j)))
                root[high] = low
    return {i: top(i) for i in ids}

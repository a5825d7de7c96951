"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

from larder.llm.byte_bpe import read_ranks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda b: hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def neighbours(ids, vectors, k=20):
    ids, v = np.array(ids), np.array(vectors, float)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = (v * v[q]).sum(1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def library_ids(texts, name):
    made = Tokenizer.from_file(public_tokenizers.path(name))
    return [made.encode(t or "", add_special_tokens=False).ids for t in texts]


def orc_tokens(docs):
    start, out = 0, {}
    ids = dict(zip((d for d, _ in docs), library_ids([t for _, t in docs], "word_bpe_49k.json")))
    for doc in sorted(ids):
        mine = [*ids[doc], 2]
        out[doc] = (start, len(mine), zlib.crc32(np.array(mine, "<u4").tobytes()))
        start += len(mine)
    return out


def fingerprint(text, width=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def simhash(docs, width=3, distance=2):
    fps = [fingerprint(t, width) for _, t in docs]
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: (f"{fps[i]:016x}", least[top(i)]) for i, (d, _) in enumerate(docs)}


def byte_bpe(texts):
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    made = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})
    return [made.encode_ordinary(t or "") for t in texts]


def repeats(docs, window=50):
    """doc -> (n_words, n_removed, digest of what is kept)"""
    first, words = {}, {d: WORD.findall(t or "") for d, t in docs}
    for d, w in words.items():
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, w in words.items():
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                keep[i:i + window] = [False] * window
        kept = [x for x, k in zip(w, keep) if k]
        out[d] = (len(w), len(w) - len(kept), sha(" ".join(kept)))
    return out


def turns(rows):
    out = defaultdict(list)
    for conv, turn, role, text in sorted(rows):
        out[conv].append((role, text or ""))
    return {c: (len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)),
                sum(len(x) for r, x in t if r == "assistant"),
                sha("".join(x for r, x in t if r == "assistant"))) for c, t in out.items()}

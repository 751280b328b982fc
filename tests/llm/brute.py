"""Plain versions of the operators, for small inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def sha(data):
    return hashlib.sha256(data).hexdigest()


def order(row):
    doc_id, text = row
    return (doc_id is None, doc_id or 0)


def cut_words(rows, length=20):
    """{doc_id: (n_words, n_removed, kept)}; ids are distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=order):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        out[doc_id] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g))
    return out


def cut_bytes(rows, length=50):
    """{doc_id: (n_bytes, n_removed, n_spans, kept)}; ids are distinct."""
    first, out = {}, {}
    for rank, (doc_id, text) in enumerate(sorted(rows, key=order)):
        data = (text or "").encode()
        gone = bytearray(len(data) + 1)
        for i in range(len(data) - length + 1):
            if first.setdefault(data[i : i + length], rank) < rank:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(data)) if gone[i] and not (i and gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), spans, bytes(x for x, g in zip(data, gone) if not g))
    return out


def shingles(text, k):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, k, percent):
    """{doc_id: (n_shingles, component_id)}; ids are distinct and not null."""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def aligned(rows, a_path, b_path):
    """{doc_id: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)}; ids are distinct."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(a_path)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=b_path)
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in visible}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
    groups, pairs = {}, Counter()
    for doc_id, text in rows:
        groups[doc_id] = []
        if not text:
            continue
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        a_bytes = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:-1], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("\u2581", " ").encode() for p in map(b_model.id_to_piece, b)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            continue
        i = j = a_at = b_at = 0
        group = ([], [])
        while i < len(a) or j < len(b):
            if a_at <= b_at and i < len(a):
                a_at, i = a_at + len(a_bytes[i]), i + 1
                group[0].append(a[i - 1])
            else:
                b_at, j = b_at + len(b_bytes[j]), j + 1
                group[1].append(b[j - 1])
            if a_at == b_at:
                groups[doc_id].append(group)
                group = ([], [])
        pairs.update({(x, y) for g in groups[doc_id] for x in g[0] for y in g[1]})
    highest = {}
    for (x, _), n in pairs.items():
        highest[x] = max(n, highest.get(x, 0))
    out = {}
    for doc_id, found in groups.items():
        links = [(x, y) for g in found for x in g[0] for y in g[1]]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)
        n_a, n_b = (sum(len(g[k]) for g in found) for k in (0, 1))
        best = sum(pairs[p] == highest[p[0]] for p in links)
        out[doc_id] = (n_a, n_b, len(found), len(links), best, sum(pairs[p] for p in links), sha(written.encode()) if found else "")
    return out


def held_out(doc_id):
    return zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % 5 == 0


def corpus(seed, n=60, vocabulary=40):
    """Texts that share passages, repeat themselves, and are copies and near copies of each other."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéñ") for _ in range(r.randint(1, 6))) for _ in range(vocabulary)]
    passages = [[r.choice(vocab) for _ in range(r.randint(18, 60))] for _ in range(5)]
    texts = []
    for i in range(n):
        w = [r.choice(vocab) for _ in range(r.randint(0, 120))]
        if r.random() < 0.6:
            at, p = r.randint(0, len(w)), r.choice(passages)
            w[at:at] = p[r.randint(0, 5) :]
        if r.random() < 0.2:
            w = w + w[: r.randint(0, len(w))]
        if texts and r.random() < 0.25:
            w = r.choice(texts).split()
            for _ in range(r.randint(0, 3)):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocab)
        texts.append(r.choice([" ", "  ", "\n"]).join(w))
    ids = r.sample(range(-50, 1000), n)
    return list(zip(ids, texts))

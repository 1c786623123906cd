"""Plain versions of what the operators compute, for small inputs."""

import hashlib
import re
from collections import Counter
from functools import lru_cache

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
RUN = re.compile("[^\x20\x09-\x0d]+")
DIR = "/root/testdata/sf0.001"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@lru_cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def plain_line(line):
    return re.sub("[ \x09-\x0d]+", " ", line).strip(" ")


def cleaned_lines(rows, min_sites=5, min_words=3):
    """(n_lines, n_removed, text) of each (doc_id, text, site)."""
    counts = lambda p: p != "" and p.count(" ") >= min_words - 1
    sites, first = {}, {}
    for doc_id, text, site in rows:
        for line in (text or "").split("\n"):
            p = plain_line(line)
            if counts(p):
                sites.setdefault(p, set()).add(site)
                if doc_id is not None:
                    first[p] = min(first.get(p, doc_id), doc_id)
    out = []
    for doc_id, text, _ in rows:
        if text is None:
            out.append((0, 0, None))
            continue
        lines = text.split("\n")
        gone = [
            len(sites.get(p := plain_line(x), ())) >= min_sites and first.get(p) != doc_id
            for x in lines
        ]
        kept = [x for x, g in zip(lines, gone) if not g]
        out.append((len(lines), sum(gone), "\n".join(kept)))
    return out


def windows(items, width=10):
    found = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    return found


def hits(text, found):
    """(words, hit positions, items) of a text."""
    w, hit, items = WORD.findall(lower(text)), set(), set()
    for n in {len(k) for k in found}:
        for i in range(len(w) - n + 1):
            if k := found.get(tuple(w[i : i + n])):
                hit |= set(range(i, i + n))
                items |= k
    return w, hit, items


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = RUN.findall(text)
    said = [x for x in text.split("\n") if RUN.search(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeat = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(said) - len(set(said)), len(repeat), failed


def shingles(text, k):
    w = RUN.findall(lower(text))
    n = min(k, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def near_components(rows, k, percent=80):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) rows with distinct ids."""
    sets = {d: shingles(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where, order = {}, sorted(sets)
    for d in order:
        shared = Counter(e for g in sets[d] for e in where.get(g, ()))
        for g in sets[d]:
            where.setdefault(g, []).append(d)
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def digest(rows):
    """(n_turns, turns_sha256, loss_chars, loss_sha256) of sorted (role, text) rows."""
    said = "".join(f"{r}\n{t}\n" for r, t in rows)
    loss = "".join(t for r, t in rows if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(rows), sha(said), len(loss), sha(loss)

"""Small inputs with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, u string, v int, bucket int, n int"


def lower(text: str | None) -> str:
    """A-Z only."""
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def texts() -> list[str | None]:
    """NULL, empty and blank texts, exact and near copies, shared passages, one long text, and ordinary ones."""
    dice = random.Random(3)
    vocabulary = ["".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=dice.randint(2, 9))) for _ in range(400)]

    def sentence(n: int) -> list[str]:
        return dice.choices(vocabulary, k=n)

    out: list[str | None] = [None, "", " \t\n", "one", "One TWO", "ä b \U0001f600 ÄB x", "a" * 5000]
    base = sentence(120)
    out += [" ".join(base)] * 4 + [" ".join(base).upper()]
    for k in range(1, 9):
        near = list(base)
        near[dice.randrange(120)] = f"changed{k}"
        out.append(" ".join(near))
    chain = list(base)
    for k in range(12):  # each is near the one before, the ends are far apart
        chain[k * 9 : k * 9 + 2] = [f"link{k}", f"step{k}"]
        out.append("  ".join(chain))
    passage = ". ".join(" ".join(sentence(12)) for _ in range(7)) + "."
    for _ in range(5):
        out.append(f"{' '.join(sentence(20))}. {passage} {' '.join(sentence(20))}.")
    out.append(" ".join(sentence(30000)))
    out += [" ".join(sentence(dice.randint(3, 90))) for _ in range(80)]
    return out


def rows() -> list[tuple]:
    """Most rows are of one source; some have none."""
    return [
        (i, None if i % 17 == 5 else ["wiki", "web", "web", "Ärger"][i % 4], "en", len(t or ""), t, "u", 1, 2, 3)
        for i, t in enumerate(texts(), 10)
    ]


def shingle_set(text: str | None, width: int) -> frozenset:
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_components(docs: dict[int, str | None], width: int, percent: int) -> dict[int, tuple[int, int]]:
    """doc_id: (set size, component), all pairs compared."""
    sets = {i: shingle_set(t, width) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, kind) of the fixed formats."""
    text, out = text or "", []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for k, (kind, pattern, group, least) in enumerate(
        [("assign", assign, 2, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16)]
    ):
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def unigram_counts(training: list[str | None]) -> Counter:
    counts: Counter = Counter()
    for t in training:
        counts.update(WORD.findall(lower(t)))
        counts["\n"] += 1
    return counts

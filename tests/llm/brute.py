"""The operators' definitions, straight from their words, over plain Python rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import product

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def near_duplicates(rows, k=4, percent=85):
    """[(doc_id, n_shingles, component_id)] of [(doc_id, text)]; ids are whole numbers."""
    sets = [shingles(t, k) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                group[find(i)] = find(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        smallest.setdefault(find(i), []).append(doc)
    return [(doc, len(sets[i]), min(smallest[find(i)])) for i, (doc, _) in enumerate(rows)]


def removed(rows, window=13):
    """[(doc_id, n_words, n_removed, kept_sha256)] of [(doc_id, text)]; NULL ids are last."""
    last = float("inf")
    words = [WORD.findall(t or "") for _, t in rows]
    ids = [last if d is None else d for d, _ in rows]
    first = {}
    for d, w in zip(ids, words, strict=True):
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            first[run] = min(first.get(run, last), d)
    out = []
    for (doc, _), d, w in zip(rows, ids, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc, len(w), len(gone), sha(" ".join(kept))))
    return out


def contaminated(rows, items, window=10):
    """[(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)]."""
    wanted = {}
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        k = min(len(w), window)
        for i in range(len(w) - k + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for k in {len(x) for x in wanted}:
            for i in range(len(w) - k + 1):
                if (run := tuple(w[i : i + k])) in wanted:
                    hit.update(range(i, i + k))
                    found |= wanted[run]
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20\-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            )
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def measured(text, window=8):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    seen, twice = set(), set()
    for r in runs:
        (twice if r in seen else seen).add(r)
    covered = {i + j for i, r in enumerate(runs) if r in twice for j in range(window)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def water_levels(sizes, weights, share, most):
    """Targets per source: cut at ``most`` times the size, the excess shared by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, cut = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in cut)
        over = [s for s in names if s not in cut]
        if not over:
            return {s: float(most * sizes[s]) for s in names}
        level = rest / sum(weight[s] for s in over)
        above = [s for s in over if weight[s] * level >= most * sizes[s]]
        if not above:
            return {s: float(most * sizes[s]) if s in cut else weight[s] * level for s in names}
        cut.update(above)


def cheapest_repair(roles, merge, insert, relabel, known):
    """Least cost of a legal conversation that keeps all turns, by trying all assignments."""
    best = None
    for assigned in product(["system", "user", "assistant"], repeat=len(roles)):
        cost = sum(relabel[r if r in known else None][a] for r, a in zip(roles, assigned, strict=True))
        state, ok = "start", True
        for a in assigned:
            if a == "system":
                if state == "start":
                    pass
                elif state == "system":
                    cost += merge
                else:
                    ok = False
                    break
            elif a == state:
                cost += min(merge, insert)
            elif a == "assistant" and state in ("start", "system"):
                cost += insert
            state = a
        if not ok:
            continue
        cost += {"system": 2 * insert, "user": insert, "assistant": 0, "start": 0}[state]
        best = cost if best is None else min(best, cost)
    return best


def aligned(rows):
    """{(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)} of [(doc_id, text)], whole texts at once."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(x): x for x in printable}
    code |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc, text in rows:
        ids_a, ids_b, groups, links = [], [], [], []
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            bytes_a = [bytes(code[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [of_b(i) for i in ids_b]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ids_a = ids_b = []
        if ids_a:
            i = j = i0 = j0 = at_a = at_b = 0
            while i < len(ids_a):
                at_a += len(bytes_a[i])
                i += 1
                while at_b < at_a:
                    at_b += len(bytes_b[j])
                    j += 1
                if at_a == at_b:
                    groups.append(",".join(map(str, ids_a[i0:i])) + "|" + ",".join(map(str, ids_b[j0:j])))
                    links.append((ids_a[i - 1], ids_b[j - 1]))
                    i0, j0 = i, j
        counts.update(links)
        found.append((doc, len(ids_a), len(ids_b), ";".join(groups), links))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (doc, n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links),
         sum(counts[x] for x in links), groups)
        for doc, n_a, n_b, groups, links in found
    ], counts


def phrases(rows, threshold=10, covered=50, top=2000):
    """[(lang, rank, phrase, a, l, r, n, score)] of [(lang, text)]."""
    counted = {}
    for lang, text in rows:
        f = counted.setdefault("und" if lang is None else lang, [Counter() for _ in range(4)])
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f[k].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counted.items():
        kept = []
        for k in (2, 3):
            for phrase, a in f[k].items():
                if a < threshold:
                    continue
                if k == 2 and any(phrase in (x[:2], x[1:]) and 100 * m >= covered * a for x, m in f[3].items() if m >= threshold):
                    continue
                cuts = [(1_000_000 * a * a // (f[j][phrase[:j]] * f[k - j][phrase[j:]]), j) for j in range(1, k)]
                score, j = min(cuts)
                kept.append((-score, -a, " ".join(phrase).encode(), f[j][phrase[:j]], f[k - j][phrase[j:]]))
        n = sum(f[1].values())
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def tokenized(text, vocabulary="word_bpe_49k.json", end=1):
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    return [*made.encode(text or "", add_special_tokens=False).ids, end]


def best_fit(lengths, room):
    """Sequences that best fit decreasing needs, piece by piece."""
    left = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, x in enumerate(left) if x >= n]
        if fitting:
            left[min(fitting, key=lambda i: left[i])] -= n
        else:
            left.append(room - n)
    return len(left)

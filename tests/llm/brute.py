"""Plain Python versions of the operators, for small inputs."""

import hashlib
from collections import Counter


def repeats(rows, length=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows."""
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s:s + length] for _, b in raws for s in range(len(b) - length + 1))
    out = []
    for i, b in raws:
        hit = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                hit[s:s + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if hit[k] and (k == 0 or not hit[k - 1]))
        kept = bytes(c for c, h in zip(b, hit) if not h)
        out.append((i, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def doc_words(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(rows, items, size=13):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows = {}
    for item, text in items:
        w = doc_words(text)
        for i in range(max(len(w) - size + 1, 1 if w else 0)):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w = doc_words(text)
        hit, found = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                items_of = windows.get(tuple(w[s:s + n]))
                if items_of:
                    hit.update(range(s, s + n))
                    found |= items_of
        found = {str(x) for x in found if x is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def base_counts(rows):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    import re

    out = []
    for i, text in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        covered = {p for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
        with_word = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        out.append((
            i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(with_word) - len(set(with_word)),
            len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    return sorted(out, key=str)


def chats(rows):
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256) of (conv_id, turn, role, text) rows."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        out.append((
            conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
            hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=str)

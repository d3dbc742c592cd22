"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def decontamination(docs, items, n=13):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    cut = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+").findall
    windows = {}
    for item, text in items:
        w = cut(fold(text))
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(str(item) if item is not None else "null")
    lengths = sorted({len(w) for w in windows})
    out = {}
    for doc, text in docs:
        w = cut(fold(text))
        hit, found = set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                got = windows.get(tuple(w[i:i + k]))
                if got:
                    hit.update(range(i, i + k))
                    found |= got
        out[doc] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def repeats(docs, n=13):
    """[(doc_id, n_words, n_removed, kept_sha256)]"""
    least = {}
    cut = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in cut:
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            if d is not None:
                least[key] = min(least.get(key, d), d)
    out = []
    for d, w in cut:
        gone = set()
        for i in range(len(w) - n + 1):
            first = least.get(tuple(w[i:i + n]))
            if first is not None and (d is None or first < d):
                gone.update(range(i, i + n))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((d, len(w), len(gone), sha(kept)))
    return out


def near_duplicates(docs, k=4, percent=80):
    """[(doc_id, n_shingles, component_id, kept)]"""
    sets = []
    for _, text in docs:
        w = fold(text).encode().split()
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    posted = {}
    for i, s in enumerate(sets):
        for x in s:
            posted.setdefault(x, []).append(i)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in posted[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def _matches(pattern, text, kind, ok):
    return [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if ok(m)]


def _digest(found, kinds):
    found = sorted(found, key=lambda s: (s[0], kinds.index(s[1])))
    return sha(",".join(f"{k}:{a}:{b}" for a, k, b in found))


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)"""
    kinds = ["assign", "access", "hex"]
    text = text or ""
    assign = r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = _matches(assign, text, "assign", lambda m: len(m[2]) >= 6)
    found += _matches("AKIA[A-Z0-9]+", text, "access", lambda m: len(m[0]) >= 20)
    found += _matches("[0-9a-f]+", text, "hex", lambda m: len(m[0]) >= 24)
    return (*[sum(s[1] == k for s in found) for k in kinds], _digest(found, kinds))


def _luhn(number):
    odd = [int(d) for d in number[::-2]]
    even = [int(d) * 2 for d in number[-2::-2]]
    return (sum(odd) + sum(d - 9 if d > 9 else d for d in even)) % 10 == 0


def pii(text):
    """(n_email, n_ip, n_card, n_phone, base_sha256)"""
    kinds = ["email", "ip", "card", "phone"]
    text = text or ""
    number = lambda m: re.sub("[^0-9]", "", m[0])
    found = _matches(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text, "email", lambda m: True)
    found += _matches(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text, "ip", lambda m: all(int(x) <= 255 for x in m[0].split(".")))
    found += _matches(r"[0-9]([\x20-]?[0-9])+", text, "card", lambda m: 12 <= len(number(m)) <= 19 and _luhn(number(m)))
    found += _matches(r"\+[0-9][\x20().0-9-]+[0-9]", text, "phone", lambda m: 9 <= len(number(m)) <= 15)
    return (*[sum(s[1] == k for s in found) for k in kinds], _digest(found, kinds))


def damage(rows):
    """[(conv, turn, role, text)] after the damage, by the checksum of conversation and turn; nulls are one blank."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repair(rows):
    """One conversation, [(turn, role, text)] in order: (gaps, blank, duplicate, truncated, illegal, cost, audit, turns)."""
    blanks, seen, faults = " \t\n\x0b\x0c\r", set(), []
    for _, role, text in rows:
        body = text.rstrip(blanks)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", [])}

    def better(table, state, one):
        if state not in table or one[:2] < table[state][:2]:
            table[state] = one
            return True
        return False

    def inserted(table):
        while any([better(table, x, (c + 3, e + "I", t + [f"{name}:"])) for s, (c, e, t) in list(table.items())
                   for x, name in (("u", "user"), ("a", "assistant")) if x in after[s]]):
            pass
        return table

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for s, (c, e, t) in inserted(best).items():
            better(new, s, (c + 4, e + "D", t))
            if fault in ("", "truncated"):
                more = 3 * (fault != "")
                if role[:1] and role[:1] in after[s]:
                    better(new, role[:1], (c + more, e + "K", t + [f"{role}:{text}"]))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if x in after[s]:
                        better(new, x, (c + 3 + more, e + "R", t + [f"{name}:{text}"]))
        best = new
    ends = inserted(best)
    cost, audit, turns = min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])
    numbers = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, turns)


def conversations(given, rows):
    """{conv: report} of the rows after damage, for every conversation of the given rows."""
    digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()
    out = {}
    for conv in {r[0] for r in given}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
        *report, turns = repair([r[1:] for r in mine])
        out[conv] = (*report, sha("\n".join(turns)))
    return out


def codes(rows, parts=16, entries=64, rounds=2, scale=256):
    """({(id, index of row): (code, error, label_error)}, hash of the codebooks) of [(id, vector, label)]."""
    kept = [(i, r[0], [math.floor(Fraction(x) * scale) for x in r[1]], r[2]) for i, r in enumerate(rows)
            if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return {}, None
    sizes = Counter(len(x) for _, _, x, _ in kept)
    usual = min(sizes, key=lambda n: (-sizes[n], n))
    full = [k for k in kept if len(k[2]) == usual]
    cut = lambda x, p: x[usual * p // parts:usual * (p + 1) // parts]
    first = sorted(full, key=lambda k: (k[1] is None, k[1] or 0, k[2]))[:entries]
    books = [[cut(k[2], p) for k in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for k in full:
                groups.setdefault(nearest(cut(k[2], p), book)[1], []).append(cut(k[2], p))
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(book)]
    out, labels = {}, Counter()
    for i, key, x, label in kept:
        found = [nearest(cut(x, p), books[p]) for p in range(parts)] if len(x) == usual else None
        error = min(sum(d for d, _ in found), 2**63 - 1) if found else None
        out[key, i] = ["".join(f"{e:02x}" for _, e in found) if found else None, error, label]
        labels[label] += error or 0
    return {k: (c, e, min(labels[label], 2**63 - 1)) for k, (c, e, label) in out.items()}, sha(",".join(str(v) for b in books for e in b for v in e))


def notices(text, phrases, texts, edits):
    """(words, [(phrase, first word)], {notice: fewest edits}) by dynamic programming over all places between words."""
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", fold(text))
    exact = [(p, i) for i in range(len(words)) for p in phrases if words[i:i + len(p.split())] == p.split()]
    near = {}
    for notice in texts:
        for i in range(len(words)):
            # Distances of the notice's beginnings to what was read from word i on.
            row = list(range(len(notice) + 1))
            for j in range(i, len(words)):
                for ch in (" " if j > i else "") + words[j]:
                    new = [row[0] + 1]
                    for k, x in enumerate(notice):
                        new.append(min(new[-1] + 1, row[k + 1] + 1, row[k] + (ch != x)))
                    row = new
                if row[-1] <= edits(notice):
                    near[notice] = min(near.get(notice, 99), row[-1])
                if min(row) > edits(notice):
                    break
    return len(words), exact, near

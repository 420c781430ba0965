"""Plain versions of the operators, for small tables: no index, no windows, all pairs."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

NOT_SPACE = re.compile("[^\x20\x09-\x0d]+")


def small_letters(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = NOT_SPACE.findall(small_letters(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(ids, codes, max_bits=3):
    """The smallest id that each id reaches over links of at most ``max_bits`` differing bits."""
    codes = np.array(codes, np.uint64)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(codes[:i] ^ codes[i]) <= max_bits).tolist():
            root[find(i)] = find(j)
    smallest = {}
    for i, doc in enumerate(ids):
        smallest[find(i)] = min(doc, smallest.get(find(i), doc))
    return [smallest[find(i)] for i in range(len(ids))]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    """The contract's patterns as they are written."""
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, "phone", m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def corpus_words(rows):
    """``word -> n`` of spelling variants, from rows of ``doc_id, text``."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = small_letters(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run if h % 31 else run[:at] + run[at + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    """Whether two words differ by one inserted, deleted or replaced letter."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def spelling_variants(rows):
    """``word, form, root, n, n_near, form_n``, every word compared with every other."""
    n = corpus_words(rows)
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}
    found = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        found.append((word, form.get(word), root, n[word], len(near[word]), n.get(form.get(word))))
    return sorted(found)


def token_bytes(path_a, path_b):
    """Both tokenizers as functions from a text to ``[(id, bytes)]``, byte by byte as the contract says."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, more = {}, 256
    for byte in range(256):
        letters[chr(byte if byte in kept else more)] = byte
        more += byte not in kept

    def of_a(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids]

    def of_b(text):
        pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        byte = lambda p: re.fullmatch("<0x(..)>", p)
        return [(i, bytes([int(byte(p)[1], 16)]) if byte(p) else p.replace("▁", " ").encode()) for i, p in pieces]

    return of_a, of_b


def alignments(rows, of_a, of_b):
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` by comparing all tokens."""
    held, counts = [], Counter()
    for doc_id, text in rows:
        a, b = (of_a(text), of_b(text)) if text else ([], [])
        spelt = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != spelt or b"".join(x for _, x in b) != spelt:
            held.append((doc_id, [], [], [], []))
            continue
        spans = []
        for tokens in (a, b):
            at, found = 0, []
            for i, x in tokens:
                found.append((i, at, at + len(x)))
                at += len(x)
            spans.append(found)
        links = []
        for i, s, e in spans[0]:
            links += [(i, j) for j, t, f in spans[1] if t < e and s < f]
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, last = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, _, e in side if last < e <= end) for side in spans))
            last = end
        counts.update(set(links))
        held.append((doc_id, a, b, links, groups))
    most = {}
    for (i, _), n in counts.items():
        most[i] = max(n, most.get(i, 0))
    return [
        (
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[0]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        )
        for doc_id, a, b, links, groups in held
    ]

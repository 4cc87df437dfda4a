"""Plain-Python brute force of the semantics, written from the rules (for small fixtures only)."""

import regex

from tokenyard.functions.text import PRETOKEN_PATTERN as PAT


def pieces(text):
    return [m.group(0) for m in regex.finditer(PAT, text)]


def split_specials(text, specials):
    """Plain text and specials in turn: at each place the longest special that starts there is cut out."""
    out, start, at = [], 0, 0
    while at < len(text):
        found = max((s for s in specials if text.startswith(s, at)), key=len, default="")
        if found:
            out += [text[start:at], found]
            start = at = at + len(found)
        else:
            at += 1
    return [*out, text[start:]]


def word_freq(texts, specials):
    wf = {}
    for text in texts:
        for seg in split_specials(text, specials):
            if seg in specials:
                continue
            for p in pieces(seg):
                key = tuple(bytes([b]) for b in p.encode())
                wf[key] = wf.get(key, 0) + 1
    return wf


def merge(seq, pair):
    out, i = [], 0
    while i < len(seq):
        if i + 1 < len(seq) and seq[i] == pair[0] and seq[i + 1] == pair[1]:
            out.append(pair[0] + pair[1])
            i += 2
        else:
            out.append(seq[i])
            i += 1
    return tuple(out)


def learn(texts, vocab_size, specials):
    """One merge at a time, recounting everything: the slowest possible learner."""
    wf = word_freq(texts, specials)
    n_vocab = 256 + len(specials)
    merges = []
    while n_vocab < vocab_size:
        counts = {}
        for w, f in wf.items():
            for a, b in zip(w, w[1:]):
                counts[(a, b)] = counts.get((a, b), 0) + f
        if not counts:
            break
        best = max(counts.items(), key=lambda kv: (kv[1], kv[0]))[0]
        merges.append(best)
        n_vocab += 1
        new = {}
        for w, f in wf.items():
            m = merge(w, best)
            new[m] = new.get(m, 0) + f
        wf = new
    return merges


def encode(text, vocab, merges, specials):
    b2id = {b: i for i, b in vocab.items()}
    rank = {p: r for r, p in enumerate(merges)}
    ids = []
    for seg in split_specials(text, specials):
        if not seg:
            continue
        if seg in specials:
            ids.append(b2id[seg.encode()])
            continue
        for p in pieces(seg):
            toks = tuple(bytes([b]) for b in p.encode())
            while True:
                cands = [(rank[q], q) for q in zip(toks, toks[1:]) if q in rank]
                if not cands:
                    break
                toks = merge(toks, min(cands)[1])
            ids.extend(b2id[t] for t in toks)
    return ids

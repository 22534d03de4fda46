"""Sequential models the operators are compared with."""

END = 256


def stream(texts):
    out = []
    for text in texts:
        if text is None or not text.strip():
            continue
        out += [*text.encode(), END]
    return out


def blocks(tokens, block, max_tokens=None):
    out, at = [], 0
    while at + block + 1 <= len(tokens):
        out.append((tokens[at : at + block], tokens[at + 1 : at + block + 1]))
        at += block
        if max_tokens and at >= max_tokens:
            break
    return out


def example(turns, block):
    ids, mask = [], []
    for role, text in turns:
        if role == "prompter":
            part = [*f"<|user|>\n{text}\n".encode()]
            lead = len(part)
        else:
            part = [*f"<|assistant|>\n{text}\n<|endofturn|>".encode()]
            lead = len(b"<|assistant|>\n")
        ids += part
        mask += [0] * lead + [1] * (len(part) - lead)
    pad = block + 1 - len(ids)
    ids, mask = (ids + [END] * pad)[: block + 1], (mask + [0] * pad)[: block + 1]
    return ids[:-1], [t if m else -1 for t, m in zip(ids[1:], mask[1:])]


def paths(messages, lang="en"):
    """Depth-first root-to-leaf paths in input order; messages are (ord, id, parent, lang) after dedup."""
    ordered = sorted(messages)
    kids = {}
    for _, ident, parent, _ in ordered:
        kids.setdefault(parent, []).append(ident)
    out = []

    def walk(ident, path):
        path = [*path, ident]
        if ident not in kids:
            out.append(path)
        for kid in kids.get(ident, []):
            walk(kid, path)

    for _, ident, parent, its in ordered:
        if parent is None and (lang is None or its == lang):
            walk(ident, [])
    return [p for p in out if len(p) >= 2]

"""The definitions under test, in plain Python."""

from collections import Counter


def special_share(text):
    special = [c for c in text if not (c.isalnum() or c.isspace())]
    return len(special) / max(len(text), 1)


def bleu(prediction, reference):
    p, r = prediction.lower().split(), reference.lower().split()
    if not (p and r):
        return 0.0
    shared = (Counter(p) & Counter(r)).total()
    return shared / len(p) * min(1.0, len(p) / len(r))


def harmonic(shared, left, right):
    if not (shared and left and right):
        return 0.0
    a, b = shared / left, shared / right
    return 2 * a * b / (a + b)


def rouge_n(prediction, reference, n):
    def grams(text):
        t = text.lower().split()
        return Counter(tuple(t[k : k + n]) for k in range(len(t) - n + 1))

    p, r = grams(prediction), grams(reference)
    return harmonic((p & r).total(), p.total(), r.total())


def longest_common(a, b):
    """Textbook table, one row at a time."""
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def rouge_l(prediction, reference):
    p, r = prediction.lower().split(), reference.lower().split()
    return harmonic(longest_common(p, r), len(p), len(r))


def stopping(losses, patience, min_delta):
    """(best, wait, stop) after every loss."""
    best, wait, out = None, 0, []
    for loss in losses:
        if best is None or loss < best - min_delta:
            best, wait = loss, 0
        else:
            wait += 1
        out.append((best, wait, wait >= patience))
    return out


def checkpoints(losses, k):
    """Which positions were saved on arrival, and which are held at the end."""
    held, saved = [], []
    for at, loss in enumerate(losses):
        if len(held) < k or loss < max(x for x, _ in held):
            saved.append(at)
            held = sorted([*held, (loss, at)])[:k]
    return set(saved), {at for _, at in held}

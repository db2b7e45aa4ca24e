"""Plain versions of the operators on small inputs."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def components(texts, percent=80):
    """Least index reachable by links, for each text."""
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(sets))], [len(s) for s in sets]


def covered(texts, length):
    """Per text the bytes that a string of ``length`` bytes with another start covers."""
    starts = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marks = [False] * len(t)
        for i in range(len(t) - length + 1):
            if starts[t[i:i + length]] > 1:
                marks[i:i + length] = [True] * length
        out.append(marks)
    return out


def runs(marks):
    return sum(m and not (i and marks[i - 1]) for i, m in enumerate(marks))


def edits(item, text):
    """Edit distance of ``item`` to the nearest stretch of ``text``."""
    last = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return min(last)

"""Documents with everything odd in them, and small helpers for brute force."""

import random

SCHEMA = "doc_id long, text string, block string, key long, n int, fp string"


def words(rnd, n, vocabulary=400):
    return [f"w{rnd.randrange(vocabulary)}x" for _ in range(n)]


def odd_rows(seed=1):
    """Nulls in any column, empty, blank and long texts, copies, near copies, repeated rows, clashing columns."""
    rnd = random.Random(seed)
    base = words(rnd, 120)
    near = list(base)
    near[60] = "changed"
    long = words(rnd, 6000, 3000)
    texts = {
        1: " ".join(base), 2: " ".join(base), 3: " ".join(near), 4: None, 5: "", 6: " \n\t ", 7: "one", 8: "One",
        9: " ".join(long), 10: " ".join(["same"] * 90), 11: "line a b c d e f\nline a b c d e f\n\nother line here",
        12: "Line A b c d e f!\n" + " ".join(words(rnd, 30)), 13: "é ñ 日本 " + " ".join(words(rnd, 40)) + "\n###$$$ |",
        14: " ".join(long[100:180]) + "\n" + " ".join(words(rnd, 50)), 15: "x" * 5000,
    }
    rows = [(i, t, "b", 5, None, None) for i, t in texts.items()]
    rows += [(2, texts[2], None, None, 1, "f"), (None, " ".join(words(rnd, 60)), "b", 1, 1, "f"), (None, None, None, None, None, None)]
    return rows


def union_find(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]

"""Small texts with the cases that operators must settle: nulls, empties, copies, near-copies, repeats, long texts."""

import random

WORDS = "the of and to in that is for on with as by at from this be are or an it stone river north paper light house tree".split()


def rows(seed=7, n=40):
    r = random.Random(seed)

    def text(k):
        return " ".join(r.choice(WORDS) + str(r.randrange(9)) * (r.random() < 0.6) for _ in range(k))

    passage = text(60)
    out = [(1000 + i, text(r.choice([3, 8, 30, 80, 150]))) for i in range(n)]
    base = text(120)
    out += [(100, base), (101, base), (102, base.upper()), (103, base + " tail"), (104, None), (105, ""), (106, " \t\n "),
            (107, "one"), (108, "one"), (109, "a b c d"), (110, "a  b\tc\nd")]
    for i in range(8):  # near-copies of near-copies, and a shared passage
        w = base.split()
        for j in range(i):
            w[(j * 13 + 5) % len(w)] = f"x{j}"
        out.append((200 + i, " ".join(w)))
        out.append((300 + i, text(20) + " " + passage + " " + text(25)))
    out += [(400, "go " * 90), (401, "ab cd " * 60), (402, "\n".join(["line one two three"] * 9 + ["other line"])),
            (403, text(6000)), (404, "naïve café Ünïcode " * 5), (405, "#*$ %&| <> " * 20)]
    return [(i, t, r.choice(["en", "de", None]), r.choice(["a", "b", "c", None])) for i, t in out]

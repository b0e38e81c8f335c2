"""Texts that tests of several operators use."""

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def prose(seed, n, alphabet=400):
    rng = random.Random(seed)
    return " ".join(rng.choice(["word", "Été", "x", "Über", "na"]) + str(rng.randrange(alphabet)) for _ in range(n))


def awkward_texts():
    """Nulls, empty and odd texts, copies, near copies, long ones, repeated lines."""
    base = [prose(i, 60 + 10 * i) for i in range(8)]
    near = base[3].replace("word", "WORD", 2).split(" ")
    near[30] = "changed"
    long = prose(99, 30_000, 100_000)
    return [None, "", " ", "\n\n", "one", "one two", "é", "🙂 \x00 tab\t", *base, base[1], base[1], base[2] + " tail", " ".join(near), base[4][:300] + "\n" + base[5], long, long[50_000:90_000], "ab" * 400, "ab" * 400, "line a\nfooter\nline b", "footer\nfooter", "<|endoftext|> ▁ don't  twice"]

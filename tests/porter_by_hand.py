"""A plain character-by-character Porter stemmer to check the column expressions with."""


def consonant(w, i):
    if w[i] in "aeiou":
        return False
    if w[i] == "y":
        return i == 0 or not consonant(w, i - 1)
    return True


def measure(w):
    shape = "".join("c" if consonant(w, i) else "v" for i in range(len(w)))
    return sum(1 for a, b in zip(shape, shape[1:]) if a == "v" and b == "c")


def vowel_in(w):
    return any(not consonant(w, i) for i in range(len(w)))


def double(w):
    return len(w) >= 2 and w[-1] == w[-2] and consonant(w, len(w) - 1)


def cvc(w):
    n = len(w)
    if n >= 3:
        return (
            consonant(w, n - 3) and not consonant(w, n - 2) and consonant(w, n - 1) and w[-1] not in "wxy"
        )
    return n == 2 and not consonant(w, 0) and consonant(w, 1)


POOL = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
TWO = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
THREE = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
FOUR = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def swap(w, table, at_least):
    for old, new in table:
        if w.endswith(old):
            stem = w[: len(w) - len(old)]
            return stem + new if measure(stem) > at_least else w
    return w


def two(w):
    if w.endswith("alli") and measure(w[:-4]) > 0:
        return two(w[:-2])
    if w.endswith("logi"):
        return w[:-1] if measure(w[:-3]) > 0 else w
    return swap(w, TWO, 0)


def past(w):
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix) and vowel_in(w[: -len(suffix)]):
            s = w[: -len(suffix)]
            if s.endswith(("at", "bl", "iz")):
                return s + "e"
            if double(s):
                return s if s[-1] in "lsz" else s[:-1]
            return s + "e" if measure(s) == 1 and cvc(s) else s
    return w


def stem(w):
    if w in POOL:
        return POOL[w]
    if len(w) <= 2:
        return w
    if w.endswith("ies"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    w = past(w)
    if w.endswith("y") and len(w) > 2 and consonant(w, len(w) - 2):
        w = w[:-1] + "i"
    w = swap(two(w), THREE, 0)
    for suffix in FOUR:
        if w.endswith(suffix):
            s = w[: -len(suffix)]
            if measure(s) > 1 and (suffix != "ion" or s.endswith(("s", "t"))):
                w = s
            break
    if w.endswith("e"):
        s = w[:-1]
        if measure(s) > 1 or (measure(s) == 1 and not cvc(s)):
            w = s
    if w.endswith("ll") and measure(w[:-1]) > 1:
        w = w[:-1]
    return w

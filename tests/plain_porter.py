"""Porter's algorithm step by step on one word, to compare with."""
from quarry.functions.porter import STEP2, STEP3, STEP4

_VOWELS = frozenset("aeiou")


def _is_cons(w: str, i: int) -> bool:
    c = w[i]
    if c in _VOWELS:
        return False
    if c == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        cons = _is_cons(stem, i)
        if cons and prev_vowel:
            m += 1
        prev_vowel = not cons
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    return (_is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2)
            and _is_cons(w, len(w) - 1) and w[-1] not in "wxy")


def _longest(w: str, suffixes):
    best = None
    for s in suffixes:
        key = s[0] if isinstance(s, tuple) else s
        if w.endswith(key) and (best is None or len(key) > len(best[0] if isinstance(best, tuple) else best)):
            best = s
    return best


def stem(word: str) -> str:
    w = word
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    again = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, again = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, again = w[:-3], True
    if again:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # step 2
    r = _longest(w, STEP2)
    if r and _measure(w[:-len(r[0])]) > 0:
        w = w[:-len(r[0])] + r[1]
    # step 3
    r = _longest(w, STEP3)
    if r and _measure(w[:-len(r[0])]) > 0:
        w = w[:-len(r[0])] + r[1]
    # step 4
    r = _longest(w, STEP4)
    if r:
        s = w[:-len(r)]
        if _measure(s) > 1 and (r != "ion" or (s and s[-1] in "st")):
            w = s
    # step 5a
    if w.endswith("e"):
        s = w[:-1]
        m = _measure(s)
        if m > 1 or (m == 1 and not _cvc(s)):
            w = s
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w

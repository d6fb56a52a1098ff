"""English word stems by Porter's published algorithm (1980).

A small per-word helper of the n-gram scores, with the later revisions common
in scoring tools: short -ies/-ied endings, -y after a consonant, -alli, -fulli
and -logi, and a list of irregular words.
"""

from __future__ import annotations

# The published suffix tables and irregular words.
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
         ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
         ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
         ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
         ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
         ("ful", ""), ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
         "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")
IRREGULAR = {"skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
             "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
             "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
             "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}


def _consonants(word: str) -> str:
    """c/v pattern of a word; y is a vowel after a consonant."""
    kinds = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and kinds[-1] == "c")
        kinds += "v" if vowel else "c"
    return kinds


def _measure(word: str) -> int:
    """Number of vowel-to-consonant changes."""
    return _consonants(word).count("vc")


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _consonants(word)[-1] == "c"


def _short_end(word: str) -> bool:
    kinds = _consonants(word)
    return (kinds.endswith("cvc") and word[-1] not in "wxy") or (len(word) == 2 and kinds == "vc")


def _plural(word: str) -> str:
    if word.endswith("ies") and len(word) == 4:
        return word[:-1]
    if word.endswith("sses") or word.endswith("ies"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        base = word[:-len(suffix)]
        if word.endswith(suffix) and "v" in _consonants(base):
            if base.endswith(("at", "bl", "iz")):
                return base + "e"
            if _double(base):
                return base if base[-1] in "lsz" else base[:-1]
            return base + "e" if _measure(base) == 1 and _short_end(base) else base
    return word


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _consonants(word)[-2] == "c":
        return word[:-1] + "i"
    return word


def _swap(word: str, table) -> str:
    for suffix, new in table:
        if word.endswith(suffix):
            base = word[:-len(suffix)]
            return base + new if _measure(base) > 0 else word
    return word


def _double_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double_suffix(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap(word, STEP2)


def _single_suffix(word: str) -> str:
    for suffix in sorted(STEP4, key=len, reverse=True):
        if word.endswith(suffix):
            base = word[:-len(suffix)]
            fits = _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t")))
            return base if fits else word
    return word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past(_plural(word)))
    return _final_e(_single_suffix(_swap(_double_suffix(word), STEP3)))

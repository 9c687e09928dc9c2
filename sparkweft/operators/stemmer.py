"""The suffix-stripping stemmer of Porter (1980), from the published rules."""

from __future__ import annotations

#: The rules of steps 2, 3 and 4.
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(word: str) -> str:
    """c for a consonant and v for a vowel, letter by letter; y after a consonant is a vowel."""
    out = ""
    for k, ch in enumerate(word):
        out += "v" if ch in "aeiou" or (ch == "y" and k > 0 and out[-1] == "c") else "c"
    return out


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short_end(word: str) -> bool:
    """Ends consonant, vowel, consonant, the last not w, x or y."""
    return len(word) >= 3 and _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _double(word: str) -> bool:
    return len(word) >= 2 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _swap(word: str, rules: dict[str, str]) -> str:
    for end in sorted((e for e in rules if word.endswith(e)), key=len, reverse=True)[:1]:
        stem = word[: -len(end)]
        return stem + rules[end] if _measure(stem) > 0 else word
    return word


def stem(word: str) -> str:
    if len(word) <= 2 or not word.isascii() or not word.isalpha():
        return word
    for end, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(end):
            word = word[: len(word) - len(end)] + new
            break
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for end in ("ed", "ing"):
            if word.endswith(end) and "v" in _shape(word[: -len(end)]):
                word = word[: -len(end)]
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif _double(word) and word[-1] not in "lsz":
                    word = word[:-1]
                elif _measure(word) == 1 and _short_end(word):
                    word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(_swap(word, STEP2), STEP3)
    for end in sorted((e for e in STEP4 if word.endswith(e)), key=len, reverse=True)[:1]:
        base = word[: -len(end)]
        if _measure(base) > 1 and (end != "ion" or base.endswith(("s", "t"))):
            word = base
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    return word[:-1] if _measure(word) > 1 and _double(word) and word[-1] == "l" else word

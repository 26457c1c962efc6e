"""Porter's stemmer for English (M. F. Porter, An algorithm for suffix stripping, 1980, with his later changes bli and logi)."""

from __future__ import annotations

import re

# The suffix rules of the published algorithm, by step.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(word: str) -> str:
    """v for each vowel, c for each consonant: y is a vowel behind a consonant."""
    out = ""
    for ch in word:
        out += "v" if ch in "aeiou" or (ch == "y" and out.endswith("c")) else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_end(stem: str) -> bool:
    """Consonant, vowel, consonant at the end, the last not w, x or y."""
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((x for x in suffixes if word.endswith(x)), key=len, default=None)


def porter(word: str) -> str:
    """The stem of a lower-case word; words of other letters, or of two letters or fewer, stay as they are."""
    if len(word) < 3 or not re.fullmatch("[a-z]+", word):
        return word
    # plurals
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past and progressive forms
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    elif (end := _longest(word, ("ed", "ing"))) and "v" in _shape(word[: -len(end)]):
        word = word[: -len(end)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
            word = word[:-1]
        elif _measure(word) == 1 and _short_end(word):
            word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for rules in (STEP_2, STEP_3):
        end = _longest(word, rules)
        if end and _measure(word[: -len(end)]) > 0:
            word = word[: -len(end)] + rules[end]
    end = _longest(word, STEP_4)
    if end and _measure(word[: -len(end)]) > 1 and (end != "ion" or word[: -len(end)].endswith(("s", "t"))):
        word = word[: -len(end)]
    # a last e, and a double l
    if word.endswith("e") and ((m := _measure(word[:-1])) > 1 or (m == 1 and not _short_end(word[:-1]))):
        word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word

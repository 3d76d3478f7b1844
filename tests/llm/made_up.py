"""Made-up texts for the tests."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SYLLABLES = {
    "en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as".split(),
    "fr": "eau oux ien ment que elle oi ai ré té ç è tion une les des ou pa vi au".split(),
    "de": "sch ung keit ein ver ge ber zu ach lich ö ü äu pf heit tz ie der".split(),
}


def prose(seed: int, words: int, lang: str = "en") -> str:
    """Made-up words, the same for the same seed."""
    out, parts = [], SYLLABLES[lang]
    for i in range(words):
        digest = hashlib.md5(f"{seed}:{i}".encode()).digest()
        out.append("".join(parts[b % len(parts)] for b in digest[1 : 2 + digest[0] % 4]))
    return " ".join(out)

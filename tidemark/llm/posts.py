"""What the author of a forum post wrote in it, sentence by sentence."""

from __future__ import annotations

import html
import re

_FLAGS = re.IGNORECASE | re.DOTALL
# Every pattern takes what it looks for whole, however long, and none can backtrack over more than a line.
_BLOCKS = (
    ("[/quote]", re.compile(r"\[quote[^\]]*\](?:(?!\[quote).)*?\[/quote\]", _FLAGS)),
    ("</blockquote>", re.compile(r"<blockquote[^>]*>(?:(?!<blockquote).)*?</blockquote>", _FLAGS)),
)
_IMAGE = re.compile(r"\[(img|url|attach)[^\]]*\].*?\[/\1\]|\[attachment[^\]]*\]", _FLAGS)
_SMALL_PRINT = re.compile(r"\[size=\d+\].*?\[/size\]", _FLAGS)
_BREAK = re.compile(r"<br\s*/?>\n?|</?p>\n?|</?div[^>]*>", re.IGNORECASE)
_TAG = re.compile(r"</?[a-z][^<>]*>|\[/?[a-z]+(?:=[^\[\]]*)?\]", re.IGNORECASE)
_QUOTE_MARKS = (">", "|", "»")
_WROTE = re.compile(r"\b(?:wrote|writes|schrieb|schreibt|escribió|dijo)\b", re.IGNORECASE)
_ENDED = re.compile(r"[.!?…]\s")
_SIGNATURE = re.compile(r"\s*(?:--|—|_{3,})\s*$")
_CLOSING = re.compile(r"\s*(?:cheers|regards|best|thanks|gruß|grüße|saludos)\s*,?\s*$", re.IGNORECASE)
_SENT_FROM = re.compile(r"\s*(?:sent from my|gesendet von|enviado desde)\b", re.IGNORECASE)
_GREETING = re.compile(
    r"\s*(?:hi|hey|hello|good (?:morning|evening|day|afternoon)|dear|hallo|moin|guten (?:tag|abend|morgen)|servus|hola|buenas|buenos días)\b"
    r"(?:[^.!?]*[,:!]|(?:[^\w.!?]+\w+){0,3}[^\w!?]*)\s*$",
    re.IGNORECASE,
)
_ATTRIBUTION_START = re.compile(r"\s*(?:on|am|el)\s+[\d.\-/]{6,}", re.IGNORECASE)
_WITHDRAWN = re.compile(r"\s*[\[<(](?:deleted|removed|withdrawn|gelöscht|entfernt|eliminado|borrado)\b[^\])>]*[\])>]\s*$", re.IGNORECASE)
_END = re.compile(r"([.!?…。？！])[\"')\]»]*\s+")
_SLIPPED = re.compile(r"([^\W\d_])\.([^\W\d_]) (?=([^\W\d_]))")
_CHARACTER = re.compile(r"[^\W_]")
# Endings of web addresses, the reserved ones among them.
_ENDINGS = "com|net|org|info|biz|shop|site|online|top|xyz|ru|cn|io|invalid|example|test"
_ADDRESS = re.compile(rf"https?://\S+|www\.\S+|\b(?:[^\W_]|-){{3,}}\.(?:{_ENDINGS})\b", re.IGNORECASE)
_TOKEN = re.compile(r"[^\W_]+")
_WORD = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*")
_PIECE = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*|\d+")
_PLAIN = str.maketrans("01345", "oieas")
_WRONG = re.compile("[ÂÃÄâð][\u0080-ÿŒ-™]{1,3}")


def _redecode(match: re.Match) -> str:
    text = match.group()
    for codec in ("cp1252", "latin-1"):
        try:
            return text.encode(codec).decode("utf-8")
        except UnicodeError:
            continue
    return text


def repaired(text: str) -> str:
    """The text with UTF-8 that was read as a one-byte code turned back, and entities resolved."""
    if not text.isascii():
        text = _WRONG.sub(_redecode, text)
    for _ in range(3 if "&" in text else 0):
        plain = html.unescape(text)
        if plain == text:
            break
        text = plain
    return text.replace(" ", " ")


def _plain_token(token: str, anyway: bool = False) -> str:
    """A token with digits that stand for letters turned back, if it has two letters in a row and no other digits."""
    if len(token) < 3 or token.isalpha() or token.isdigit():
        return token
    letters = "".join("a" if c.isalpha() else c for c in token)
    if letters.strip("a01345") or not any(c in letters for c in "01345") or not (anyway or "aa" in letters):
        return token
    return token.translate(_PLAIN)


def undisguised(text: str) -> str:
    """Digits that stand for letters inside a word turned back into them; after a point even without two letters in a row."""
    return _TOKEN.sub(lambda m: _plain_token(m.group(), m.start() > 0 and text[m.start() - 1] == "."), text)


def _is_attribution(line: str) -> bool:
    """Whether a line only says who wrote what follows: it ends with a colon and no sentence ends inside it."""
    bare = line.rstrip()
    return bare.endswith(":") and bool(_WROTE.search(bare)) and not _ENDED.search(bare)


def own_lines(text: str | None) -> list[str]:
    """The lines of a post that its author wrote: no quotes, greetings, signatures or markup.

    A null, empty, blank or withdrawn post has none.
    """
    if not text or not text.strip():
        return []
    text = repaired(text)
    marked = "[" in text or "<" in text
    if marked:
        for end, block in _BLOCKS:
            before = None
            while before != text and end in text.lower():  # the innermost first
                before, text = text, block.sub("\n", text)
        if "[" in text:
            text = _SMALL_PRINT.sub("\n", _IMAGE.sub("\n", text))
    if any(mark in text for mark in _QUOTE_MARKS):
        # a quoted line is quoted to its end, paragraphs in it included
        text = "\n".join(line for line in text.split("\n") if not line.lstrip().startswith(_QUOTE_MARKS))
    if marked:
        text = _BREAK.sub("\n", text)
    lines: list[str] = []
    for line in text.split("\n"):
        bare = line.strip()
        if not bare:
            continue
        if bare[0] in "-—_" and _SIGNATURE.match(line):
            break
        if bare[0] in ">|»" or (bare[-1] == ":" and _is_attribution(line)) or (bare[0] in "oaeOAE" and _ATTRIBUTION_START.match(line)):
            continue
        if (bare[0] in "sgeSGE" and _SENT_FROM.match(line)) or (bare[0] in "[<(" and _WITHDRAWN.match(line)):
            continue
        if marked:
            bare = _TAG.sub(" ", line).strip()
        if bare:
            lines.append(bare)
    # a greeting before the first sentence, a closing word and a name after the last
    first = 0
    while first < len(lines) and _GREETING.match(lines[first]):
        first += 1
    lines = lines[first:]
    for i in range(len(lines) - 1, max(-1, len(lines) - 4), -1):
        if _CLOSING.match(lines[i]):
            return lines[:i]
    return lines


def _put_back(match: re.Match) -> str:
    before, after, follows = match.groups()
    return f"{before}{after}. " if before.islower() and after.islower() and follows.isupper() else match.group()


def sentences(text: str | None) -> list[str]:
    """The sentences of the author's own text, over line breaks."""
    own = " ".join(own_lines(text))
    if "." in own:
        # a full stop that slipped before a sentence's last letter is put back
        own = _SLIPPED.sub(_put_back, own)
    pieces = [p.strip() for p in _END.sub(r"\1\n", own).split("\n")]
    return [p for p in pieces if _CHARACTER.search(p)]


def has_address(sentence: str) -> bool:
    """Whether a sentence gives a web address, disguised or not."""
    point = sentence.find(".")
    if not 0 <= point < len(sentence) - 2 and "://" not in sentence:
        return False
    return bool(_ADDRESS.search(sentence) or _ADDRESS.search(undisguised(sentence)))


def tokens(text: str) -> list[str]:
    """Runs of letters and digits in lower case, parts with hyphens and apostrophes together; each is ``words_of`` something."""
    return _WORD.findall(text.lower())


def words_of(token: str) -> list[str]:
    """The words of a token, mostly one: itself; numbers are all alike, and what disguises a word is turned back."""
    if token.isalpha():
        return [token]
    plain = _TOKEN.sub(lambda m: _plain_token(m.group()), token)
    return ["0" if w[0].isdigit() else w for w in _PIECE.findall(plain)]


def words(text: str) -> list[str]:
    return [w for t in tokens(text) for w in words_of(t)]


def features(sentence: str) -> list[str]:
    """Words and pairs of neighbours."""
    own = words(sentence)
    return [*own, *(f"{a} {b}" for a, b in zip(own, own[1:], strict=False))]

"""Pages of repeated keywords, links or product tags instead of sentences.

A page is cut into lines, hard-wrapped lines are joined again, and every
sentence is judged by its structure alone, whatever its language: a clause has
enough words, most of them different, few links and list signs, and it ends like
one or brings words that its neighbourhood doesn't have.  The page's suffix automaton over tokens (links,
numbers and hashtags by their kind, words without disguise) gives, at every
token, the longest substring ending there that occurs again; characters that
such substrings cover count where the page has neither clauses nor records
(logs, tables, listings, structures, sequences, settings, references).  A
sentence that is said seven times or more is no clause.  A page is stuffed where
these characters are most of it.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least part of the characters, least number of them, and characters that make a single token's repeat count.
SHARE, LEAST_CHARS, LEAST_REPEAT = 0.4, 40, 8
#: Links and hashtags make a list by their kind; they are compared as such.
LISTED = ("<url>", "<tag>")
KINDS = {"url": "<url>", "hash": "<tag>", "number": "<n>", "code": "<id>"}
#: Nats by which one more token makes a chance repeat rarer in natural text (its collision entropy).
TOKEN_NATS = 4.6
#: A sentence that doesn't end like one is a clause from PLAIN_WORDS words on, if at most AGAIN_OPEN of them stand in it
#: before or within NEAR tokens of it.
NEAR, AGAIN_OPEN, PLAIN_WORDS = 60, 0.5, 8
#: Greatest number of list signs a word (in sentences that end like one, and in others), and least part of the words of a
#: sentence that are different, in windows of WINDOW words.
SIGNS, SIGNS_OPEN, DIFFERENT, WINDOW = 0.3, 0.15, 0.78, 24
#: Where so many of the words are of three letters at most, as the small words between others are, fewer need be different.
GLUE, DIFFERENT_GLUED = 0.36, 0.62
#: Greatest part of a sentence that pairs of words which it holds twice may make up.
TWICE = 0.34
#: Times that a sentence is said before it is no clause.
SAID = 7
#: Weight of what no repeat covers in a list (more than SIGNS list signs a word).
LIST = 0.25

#: Letters of other scripts and digits that stand in for Latin letters.
LOOKALIKES = str.maketrans("аеорсухікмтвнАЕОРСУХІКМТВНοαερτυνιΟΑΕΡΤΥΝΙ", "aeopcyxikmtbhAEOPCYXIKMTBHoaeptuviOAEPTYNI")
DIGIT_LETTERS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_INVISIBLE = regex.compile(r"[\p{Cf}­͏ᅟᅠ឴឵ㅤ]+")
_URL = regex.compile(r"(?:https?://|www\.)[^\s<>\"'()\[\]|,;»]+|(?<![\w./@-])(?:[\p{L}\d-]+\.)+\p{L}{2,}(?![\w-])(?:/[^\s<>\"'()\[\]|,;»]*)?", regex.I)
_TOKEN = regex.compile(rf"(?P<url>{_URL.pattern})|(?P<hash>#[\w]+)|(?P<code>\b\p{{L}}{{1,6}}-?\d[\d-]+\b|\b\d[\d_]*_\d+\b)|(?P<number>\d+(?:[.,:]\d+)*(?!\p{{L}}))|(?P<han>[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}])|(?P<word>[^\W_\p{{Han}}\p{{Hiragana}}\p{{Katakana}}](?:[^\W\p{{Han}}\p{{Hiragana}}\p{{Katakana}}]|['’])*)", regex.I)
#: Words as the structure of a sentence needs them, and what may be a link or a tag.
_WORDS, _DOTTED = re.compile(r"\b[^\W\d_][^\W_]*(?:['’][^\W\d_]+)?"), re.compile(r"://|\w\.[^\W\d]|#\w")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_SENTENCE = re.compile(r"(?:[^.!?。！？]|[.!?](?![\s\"'”’).!?]|$))++(?:[.!?。！？]+[\"'”’)]*)?|[.!?。！？]+")
_ENDS = tuple(".!?。！？…")
#: Signs that stand between the items of a list.
_SIGNS = re.compile(r"[,;|•·»«:>/★☆]|(?<=\s)[-–—*+~](?=\s)|、|\(\s*\d+\s*\)")
#: The same of ASCII in parts: signs that always count, and what may be one of the others.
_ALWAYS, _SOMETIMES, _OTHERS = ",;|:>/", "-*+~(", re.compile(r"(?<=\s)[-*+~](?=\s)|\(\s*\d+\s*\)")
#: _WORDS of lower-case ASCII.
_ASCII_WORDS = re.compile(r"[a-z](?<!\w\w)[a-z0-9]*+(?:'[a-z]++)?", re.ASCII)
#: Blanks between the characters of a script that writes none.
_GAP = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]\s+[\p{Han}\p{Hiragana}\p{Katakana}]")
#: Record lines that a pattern at their start tells: time stamps, references, settings, comments, numbered paths.
_STAMP, _REFERENCE = re.compile(r"\[?\d{1,4}[-:./]\d\d[-:./]\d\d"), re.compile(r"\[\d+\]\s")
_SETTING, _NUMBERED_PATH = re.compile(r"[\w.-]+\s*[:=]\s*[\w.+-]*$"), re.compile(r"\d+\s+\S*/\S+$")
#: Signs that source text and drawn tables are full of.
_CODE = re.compile(r"[(){}\[\]<>=+*/\\|&^%$#@~;:\"'`_-]")
#: A path whose first part is a host's name is a link and no file.
_HOST = re.compile(r"(?:[\w-]+\.)+[A-Za-z]{2,}/")
_FILE = re.compile(r"[\w.-]*/[\w./-]*\.[A-Za-z]\w{1,5}$")
_STRUCTURE = re.compile(r"(?:[BCNOSPFIHKbcnosp]|Cl|Br|Na|Si|[0-9=#()\[\]@+\-/\\.%lri])+$")
_ATOM_WORDS = frozenset("ATOM HETATM REMARK TER END SEQRES".split())


def is_record(line: str) -> bool:
    """Whether a line is a record of a log, table, listing, structure, sequence, setting or reference."""
    if line.count("\t") >= 2:
        return True
    s = line.strip()
    first = s[0]
    words = s.split(None, 2)
    head = words[0]
    if first in "[0123456789" and (_STAMP.match(s) or _REFERENCE.match(s) or _NUMBERED_PATH.match(s) and "://" not in s):
        return True
    if head in _ATOM_WORDS or first == "#" and len(head) == 1 or len(s) == 10 and s.lower() == "references":
        return True
    if len(words) == 1 and (first == ">" and len(s) > 1 or len(s) >= 20 and s.isascii() and s.isupper() and s.replace("*", "").replace("-", "").isalpha()):
        return True
    if first in ">.($[{<+|'\"" and "://" not in s and len(_CODE.findall(s)) > len(s) / 5 or s.startswith((">>> ", "... ")):
        return True
    if len(words) <= 3 and (":" in s or "=" in s) and "://" not in s and _SETTING.match(s):
        return True
    if "/" in s:
        last = s.rsplit(None, 1)[-1]
        if "/" in last and "://" not in last and not _HOST.match(last) and _FILE.match(last):
            return True
    return len(words) <= 2 and any(c in "0123456789=#()[]" for c in head) and bool(_STRUCTURE.match(head)) and not head.isdigit()


def plain(text: str) -> str:
    """Without disguise: compatibility forms, no invisible characters, Latin letters for lookalikes, one line end."""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    return text.replace("\r\n", "\n").replace("\r", "\n")


def _word(text: str) -> str:
    if not text.isascii():
        latin = text.translate(LOOKALIKES)
        if latin.isascii() or any("a" <= c.lower() <= "z" for c in text):
            text = latin
    text = text.lower()
    if not text.isalpha() and sum(map(str.isalpha, text)) > len(text) / 2:
        text = "".join(DIGIT_LETTERS.get(c, c) for c in text)
    return text


#: Words seen by a worker, as compared; emptied when full.
_MEMO: dict[str, str] = {}


def word(text: str) -> str:
    """A word as it is compared: lower case, lookalikes and digits inside letters undone."""
    known = _MEMO.get(text)
    if known is None:
        if len(_MEMO) > 200_000:
            _MEMO.clear()
        known = _MEMO[text] = _word(text)
    return known


@dataclass
class Automaton:
    """Suffix automaton of a token sequence; ``repeats[i]`` is the length of the longest substring ending at ``i`` that occurs twice."""

    repeats: list[int]

    @classmethod
    def of(cls, tokens: list[str]) -> Automaton:
        nxt: list[dict[str, int]] = [{}]
        link, length, count = [-1], [0], [0]
        last, prefix = 0, []
        for t in tokens:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            count.append(1)
            p = last
            while p >= 0 and t not in nxt[p]:
                nxt[p][t] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][t]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(nxt[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    count.append(0)
                    while p >= 0 and nxt[p].get(t) == q:
                        nxt[p][t] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
            prefix.append(cur)
        order = sorted(range(1, len(nxt)), key=length.__getitem__, reverse=True)
        for s in order:
            count[link[s]] += count[s]
        longest = [0] * len(nxt)  # of the nearest suffix that occurs twice
        for s in reversed(order):
            longest[s] = length[s] if count[s] > 1 else longest[link[s]]
        return cls([longest[s] for s in prefix])


def unwrapped(lines: list[str]) -> list[tuple[str, bool]]:
    """Lines and whether they are records.  Lines that a paragraph was broken into are one again: in a run of lines each
    but the last is followed by a word that would not have fitted into the run's width."""
    out: list[tuple[str, bool]] = []
    run: list[str] = []

    def close() -> None:
        if len(run) > 1:
            width = max(map(len, run))
            if width >= 40 and all(len(x) + 1 + len(y.split(None, 1)[0]) > width for x, y in zip(run, run[1:])):
                out.append((" ".join(x.strip() for x in run), False))
                run.clear()
                return
        out.extend((x, False) for x in run)
        run.clear()

    for line in lines:
        if not line or line.isspace():
            close()
            continue
        if is_record(line):
            close()
            out.append((line, True))
            continue
        if run and len(line) - len(line.lstrip()) > len(run[-1]) - len(run[-1].lstrip()) + 3:
            close()  # a deeper indent starts something else
        run.append(line.rstrip())
    close()
    return out


@dataclass(slots=True)
class Sentence:
    """A sentence or record: its characters, whether it is a clause by its structure, a list, and loose (neither clause nor record); the place of its tokens."""

    text: str
    size: int
    clause: bool
    listed: bool
    loose: bool
    first: int = 0
    past: int = 0


def _ends(text: str) -> bool:
    """Whether a sentence ends like one."""
    return text.rstrip("\"'”’)»* \t")[-1:] in _ENDS


def _said_nearby(keys: list[str], parts: list[Sentence], wanted: list[int]) -> dict[int, float]:
    """Of each wanted sentence, the part of its words that stand in it before, or within NEAR tokens of it."""
    before = [-1] * len(keys)
    after = [1 << 60] * len(keys)
    last: dict[str, int] = {}
    for i, k in enumerate(keys):
        j = last.get(k)
        if j is not None:
            before[i] = j
            after[j] = i
        last[k] = i
    out: dict[int, float] = {}
    for w in wanted:
        p = parts[w]
        low, high = max(0, p.first - NEAR), p.past + NEAR
        hits = n = 0
        for i in range(p.first, p.past):
            if keys[i] in ("<n>", "<id>") or _CJK.match(keys[i]):
                continue  # figures say nothing about clauses, nor do single characters of a script of many
            n += 1
            hits += before[i] >= low or _next_outside(after, i, p.past) < high
        out[w] = hits / n if n else 0.0
    return out


def _next_outside(after: list[int], i: int, past: int) -> int:
    """The next place of the token at ``i`` behind its sentence."""
    j = after[i]
    while j < past:
        j = after[j]
    return j


def _signs(text: str) -> int:
    """Number of list signs."""
    if not text.isascii():
        return len(_SIGNS.findall(text))
    n = sum(map(text.count, _ALWAYS))
    return n + len(_OTHERS.findall(text)) if any(map(text.__contains__, _SOMETIMES)) else n


def _structure(text: str) -> tuple[bool, bool]:
    """(clause, list) by the structure within the sentence: a clause has enough words, most of them different, few links,
    tags and list signs; a list has many such signs."""
    links, bare = 0, text
    if ("." in text[:-1] or "#" in text or ":" in text) and _DOTTED.search(text):
        bare, links = _URL.subn(" ", text)
        links += bare.count("#")
    signs = _signs(bare)
    if bare.isascii():
        words = _ASCII_WORDS.findall(bare.lower())
    else:
        words = _WORDS.findall(bare.lower())
        if han := _CJK.findall(bare):
            n = len(han) + sum(not _CJK.search(w) for w in words)
            if len(han) > n / 2:
                pairs = list(zip(han, han[1:]))
                fine = n >= 6 and links <= n / 2 and signs <= n / 6 and len(_GAP.findall(bare)) <= len(han) / 12 and len(set(pairs)) > 0.6 * len(pairs)
                return fine, signs > SIGNS * n
        words = [word(w) for w in words]
    n = len(words)
    if n < 4 or links > n / 2:
        return False, signs > SIGNS * max(1, n)
    if signs > (SIGNS if _ends(text) else SIGNS_OPEN) * n:
        return False, signs > SIGNS * n
    if len(set(words)) == n:
        return True, False
    # long sentences repeat words: means over windows do not depend on the length
    size = min(n, WINDOW)
    windows = [words[i : i + size] for i in range(0, n - size + 1, max(1, size // 2))]
    different = sum(len(set(w)) for w in windows) / (size * len(windows))
    if different < DIFFERENT and (different < DIFFERENT_GLUED or sum(len(w) <= 3 for w in words) < GLUE * n):
        return False, False
    pairs = [list(zip(w, w[1:])) for w in windows] if different < 1 else []
    twice = sum(2 * c for p in pairs if len(set(p)) < len(p) for c in Counter(p).values() if c > 1)
    return twice <= TWICE * size * len(windows), False


def _solid(text: str) -> int:
    """Characters other than white space."""
    return len("".join(text.split()))


def _mostly_clauses(sentences: list[tuple[str, str]], sizes: list[int], rest: int, limit: float, judged: dict[int, tuple[bool, bool]]) -> bool:
    """Whether, of ``rest`` characters outside records, less than ``limit`` can lie outside clauses that end like one and
    are not said too often.  Sentences are judged from the longest on until that is known; ``judged`` takes what was found."""
    often: set[str] = set()
    if len(sentences) - len({key for _, key in sentences}) >= SAID - 1:
        often = {key for key, n in Counter(key for _, key in sentences).items() if n >= SAID}
    able = [k for k, (m, key) in enumerate(sentences) if _ends(m) and key not in often]
    could = sum(sizes[k] for k in able)
    for k in sorted(able, key=sizes.__getitem__, reverse=True):
        if rest - could >= limit:
            return False
        judged[k] = _structure(sentences[k][0])
        could -= sizes[k]
        if judged[k][0]:
            rest -= sizes[k]
            if rest < limit:
                return True
    return False


def stuffed_share(text: str | None, least: float = 0.0) -> tuple[float, int]:
    """Part of the page's characters that repeated substrings outside clauses and records cover, and their number.

    The whole text is read, however long.  NULL, empty and blank texts give
    (0, 0), as do pages of which less than ``least`` lies outside clauses and
    records: no repetition could bring them to that share, so their automaton
    isn't needed.  What no repeat covers counts a quarter in a list of items.
    Repeats must be longer than those that chance brings about in natural text
    of the page's length.
    """
    if not text or not text.strip():
        return 0.0, 0
    lines = unwrapped(plain(text).split("\n"))
    cut = [None if record else _SENTENCE.findall(line) for line, record in lines]
    sentences = [(m, " ".join(m.split())) for own in cut for m in own or ()]
    sizes = [len(key) - key.count(" ") for _, key in sentences]
    rest = sum(sizes)
    total = rest + sum(_solid(line) for line, record in lines if record)
    judged: dict[int, tuple[bool, bool]] = {}
    if rest < least * total or _mostly_clauses(sentences, sizes, rest, least * total, judged):
        return 0.0, 0
    parts: list[Sentence] = []
    k = 0
    for (line, _), own in zip(lines, cut):
        if own is None:
            parts.append(Sentence(line, _solid(line), False, False, False))
            continue
        for m in own:
            clause, listed = judged.get(k) or _structure(m)
            parts.append(Sentence(m, sizes[k], clause, listed, not clause))
            k += 1
    said = Counter(" ".join(p.text.split()) for p in parts if p.clause)
    if said and max(said.values()) >= SAID:
        for p in parts:
            if p.clause and said[" ".join(p.text.split())] >= SAID:
                p.clause, p.loose = False, True
    open_ = [i for i, p in enumerate(parts) if p.clause and not _ends(p.text)]
    most = sum(p.size for p in parts if p.loose) + sum(parts[i].size for i in open_)
    if not total or not most or most < least * total:
        return 0.0, 0
    keys: list[str] = []
    weight: list[float] = []
    for p in parts:
        found = [(x.lastgroup, x[0]) for x in _TOKEN.finditer(p.text)]
        p.first = len(keys)
        if found:
            lengths = [len(x) for _, x in found]
            scale = p.size / sum(lengths)  # signs between tokens belong to the tokens, in proportion
            keys += [KINDS.get(kind) or _MEMO.get(x) or word(x) for kind, x in found]
            weight += [n * scale for n in lengths]
        p.past = len(keys)
    nearby = _said_nearby(keys, parts, open_) if open_ else {}
    for i in open_:
        parts[i].loose = parts[i].past - parts[i].first < PLAIN_WORDS or nearby[i] > AGAIN_OPEN
    loose = sum(p.size for p in parts if p.loose)
    if not loose or loose < least * total:
        return 0.0, 0
    least_tokens = max(2, round(2 * math.log(max(2, len(keys))) / TOKEN_NATS))
    repeats = Automaton.of(keys).repeats
    covered = bytearray(len(keys))
    upto = len(keys)
    for i in range(len(keys) - 1, -1, -1):
        n = repeats[i]
        if i - n + 1 >= upto:
            continue  # all of it is covered
        if n >= least_tokens or n and (weight[i] >= LEAST_REPEAT and n >= least_tokens - 1 or keys[i] in LISTED):
            for j in range(min(i, upto - 1), i - n, -1):
                covered[j] = 1
            upto = min(upto, i - n + 1)
    chars = 0.0
    for p in parts:
        if p.loose:
            n = sum(compress(weight[p.first : p.past], covered[p.first : p.past]))
            chars += n + (LIST * (p.size - n) if p.listed else 0.0)
    return chars / total, int(chars)


def score_pages(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.0) -> DataFrame:
    """``key, share, chars`` of every page (see ``stuffed_share``); no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [stuffed_share(t, least) for t in b[text]]
            yield pd.DataFrame({key: b[key], "share": [s for s, _ in got], "chars": [n for _, n in got]})

    schema = f"{key} {docs.schema[key].dataType.simpleString()}, share double, chars long"
    return docs.select(key, text).mapInPandas(run, schema)


def stuffed_pages(docs: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """Keys of the pages that are stuffed for the most part; reposts are pages of their own."""
    return score_pages(docs, key, text, share).where((F.col("share") >= share) & (F.col("chars") >= LEAST_CHARS)).select(key)

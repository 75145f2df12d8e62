"""Secret scans: fixed patterns and a conditional random field over tokens."""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import in_parts, kept, packed, whole
from loomcast.llm.crf import ChainField

# Fixed patterns: kind, pattern, and the characters that group must have (0: the whole match).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")

OUTSIDE, BEGIN, INSIDE = range(3)
# O may not be followed by I; a chain does not start inside.
OPEN = np.array([[True, True, False], [True, True, True], [True, True, True]])

# A word of a text, its marks aside: what a quoted, bracketed or assigned value is in the end.
_LEADING = "\"'`([{<,;"
_TRAILING = "\"'`)]}>,;.!?:"
_NAMED = re.compile(r"""([A-Za-z_][\w.-]*["'`]?)([=:]+)(?!//)(.+)""")
_SPLIT = re.compile(r"[_.=-]")
_RUNS = (re.compile(r"[A-Z]+"), re.compile(r"[a-z]+"), re.compile(r"[0-9]+"))
_KEYWORDS = frozenset(
    "password passwd pwd passphrase secret token apikey api_key key auth authorization bearer credential credentials "
    "private access client_secret access_token pass login signature".split()
)
LONGEST = 200  # tokens of a chain
FEATURES = 1 << 14


@dataclass(frozen=True)
class Span:
    """Half-open range of code points and how it was found."""

    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start, then kind as listed."""
    found = []
    if ":" in text or "=" in text:
        found += [Span("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [Span("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [Span("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


@dataclass(frozen=True)
class Token:
    """A value inside a word between white space: its place there, and the marks on both sides."""

    start: int
    end: int
    mark: str
    following: str


def tokens_of(word: str) -> list[Token]:
    """Tokens of a word: the word without outer marks, or a name and the value it is given."""
    a, b = 0, len(word)
    while a < b and word[a] in _LEADING:
        a += 1
    closing = word.find(word[a - 1], a) if a and word[a - 1] in "\"'`" else -1
    if closing > a and word[closing + 1 : closing + 2] not in (":", "="):
        b = closing
    while b > a and word[b - 1] in _TRAILING:
        b -= 1
    if a == b:
        return [Token(0, len(word), "-", "-")]
    named = _NAMED.fullmatch(word, a, b)
    if not named:
        return [Token(a, b, word[a - 1] if a else "-", word[b] if b < len(word) else "-")]
    first = named.start(3)
    while first < b - 1 and word[first] in _LEADING:
        first += 1
    return [
        Token(a, named.end(1), word[a - 1] if a else "-", named[2][0]),
        Token(first, b, named[2][0], word[b] if b < len(word) else "-"),
    ]


def _entropy(token: str) -> float:
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())


def _shape(token: str) -> str:
    """Runs of capitals, small letters and digits as one letter each, others as they are."""
    kinds = token
    for run, sign in zip(_RUNS, "Aa9", strict=True):
        kinds = run.sub(sign, kinds)
    return kinds if len(kinds) <= 6 else "mixed" + "".join(sorted(set(kinds)))


def _marks(mark: str, following: str) -> list[str]:
    return [f"mark={mark if mark in ':=/@+#(' + chr(34) + chr(39) else '-'}", f"next={following if following in '@:/%?' else '-'}"]


def _is_plain(token: str) -> bool:
    """Whether a token is letters in ordinary case, as nearly all of prose are."""
    return token.isalpha() and (token.islower() or token[1:].islower())


def own_features(token: str, mark: str, following: str) -> list[str]:
    """What a token tells by itself and its marks."""
    n = len(token)
    marks = _marks(mark, following)
    if _is_plain(token):
        return ["bias", "plain", f"length={min(n, 64) // 4}", f"varied={len(set(token)) * 4 // n}", *marks]
    letters = sum(c.isalpha() for c in token)
    digits = sum(c.isdigit() for c in token)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False))
    cases = sum(a.isupper() != b.isupper() for a, b in zip(token, token[1:], strict=False) if a.isalpha() and b.isalpha())
    return [
        "bias",
        f"length={min(n, 64) // 4}",
        f"shape={_shape(token)}",
        f"entropy={int(_entropy(token) * 2)}",
        f"digits={digits * 4 // n}",
        f"letters={letters * 4 // n}",
        f"turns={min(turns, 6)}",
        f"cases={min(cases, 6)}",
        f"kinds={any(c.isupper() for c in token)}{any(c.islower() for c in token)}{digits > 0}{letters + digits < n}",
        f"hex={not token.lower().strip('0123456789abcdef')}",
        f"ascii={token.isascii()}",
        f"dots={min(3, token.count('.'))}",
        f"dashes={min(4, token.count('-'))}",
        f"slashes={min(3, token.count('/'))}",
        f"at={'@' in token}",
        f"head={token[:4].lower()}",
        f"head3={token[:3]}",
        f"tail={token[-2:].lower()}",
        f"edge={token[0] if not token[0].isalnum() else 'w'}{token[-1] if not token[-1].isalnum() else 'w'}",
        *marks,
    ]


def neighbour_word(token: str) -> str:
    """The form in which a token is a neighbour of others."""
    return token.lower()


def _is_keyword(word: str) -> bool:
    return word in _KEYWORDS or any(p in _KEYWORDS for p in _SPLIT.split(word))


# A token has features of these neighbours: their word if it is a known one, and whether it is a keyword.
NEIGHBOURS = (-3, -2, -1, 1, 2)


def file_features(text: str, odd: int) -> list[str]:
    """What a file tells about each of its tokens; ``odd`` of them are not plain words."""
    lines = text.count("\n") + 1
    marks = sum(text.count(c) for c in "{};=")
    return [f"odd={min(odd, 4)}", f"code={min(3, marks * 4 // lines)}", f"size={min(6, len(text) // 500)}"]


def _hashed(features: list[str]) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % (FEATURES - 1) + 1 for f in features]


def words_and_lines(text: str) -> tuple[list[str], list[int]]:
    """Words between white space, and how many every line has."""
    words: list[str] = []
    counts = []
    for line in text.split("\n"):
        own = line.split()
        words += own
        counts.append(len(own))
    return words, counts


def chain_lengths(counts: list[int], ends: np.ndarray, per_word: np.ndarray) -> np.ndarray:
    """Tokens of each chain: a chain ends with a sentence, and with a line unless it or the next one
    is one word alone, as in a block of keys; it has ``LONGEST`` tokens at most.

    ``ends`` marks words that end a sentence, ``per_word`` has their tokens.
    """
    cut = ends.copy()
    sizes = np.array(counts, np.int64)
    last = np.cumsum(sizes) - 1
    following = np.append(sizes[1:], 0)
    cut[last[(sizes > 1) & (following != 1)]] = True
    if len(cut):
        cut[-1] = True
    at = np.cumsum(per_word)[np.flatnonzero(cut)]
    lengths = np.diff(at, prepend=0)
    if (lengths > LONGEST).any():
        lengths = np.array([k for n in lengths for k in (*[LONGEST] * (n // LONGEST), n % LONGEST) if k], np.int64)
    return lengths


def training_texts(seed: int = 7, count: int = 2000) -> list[tuple[str, list[tuple[int, int]]]]:
    """Short files made from templates, with the spans of their secrets.

    Secrets: keys and tokens of well-known makes, key blocks over several tokens, and passwords:
    short ones, without digits, with other marks; these only after words that announce them.
    Others: mail addresses, numbers of phones and cards, addresses, links, versions, dates,
    identifiers, long compounds, names in several cases, and prose about passwords.
    """
    rng = random.Random(seed)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    low, up, num = string.ascii_lowercase, string.ascii_uppercase, string.digits
    alnum, b64, hexa = low + up + num, low + up + num + "+/", num + "abcdef"
    word = lambda: pick(low, rng.randint(2, 9))
    secrets = (
        lambda: "ghp_" + pick(alnum, 36),
        lambda: "sk_live_" + pick(alnum, 24),
        lambda: "sk-" + pick(alnum, 40),
        lambda: "xoxb-" + pick(num, 11) + "-" + pick(alnum, 24),
        lambda: "AIza" + pick(alnum + "_-", 35),
        lambda: "glpat-" + pick(alnum, 20),
        lambda: "eyJ" + pick(alnum, 20) + "." + "eyJ" + pick(alnum, 40) + "." + pick(alnum + "-_", 43),
        lambda: "AKIA" + pick(up + num, 16),
        lambda: pick(hexa, rng.choice((32, 40, 64))),
        lambda: pick(b64, 40),
        lambda: pick(alnum, rng.randint(20, 48)),
        lambda: pick(b64, 42) + "==",
    )
    odd = lambda w: "".join(c.upper() if k % 2 else c for k, c in enumerate(w))
    passwords = (
        lambda: pick(low, rng.randint(4, 11)) + pick(num, rng.randint(1, 4)) + pick(low, rng.randint(0, 4)),
        lambda: pick(low, rng.randint(4, 11)) + pick(num, rng.randint(1, 4)),
        lambda: pick(up, 1) + pick(low, rng.randint(3, 7)) + pick("!@#$%&*", 1) + pick(num, rng.randint(1, 4)),
        lambda: pick(up, 1) + pick("@$!03", 1) + pick(low, 3) + pick("!#%", 1) + pick(low + num, 4) + pick("#!$", 1) + pick(num, 4),
        lambda: odd(pick(low, rng.randint(10, 24))),
        lambda: pick(low + up, rng.randint(10, 24)),
        lambda: pick(alnum + "!@#$%^&*", rng.randint(9, 20)),
        lambda: word() + pick("-_.", 1) + word() + pick("-_.", 1) + pick(num, 2) + pick("*#$", 1),
        lambda: pick(low, 3) + pick(num, 2) + pick(low, 2) + pick(num, 2),
    )
    others = (
        lambda: pick(up, 1) + pick(low, 4) + pick(up, 1) + pick(low, 4),
        lambda: word() + pick(up, 1) + word() + pick(up, 1) + word(),
        lambda: pick(up, rng.randint(2, 6)),
        lambda: rng.choice((word(), word().capitalize())) + rng.choice(("", "", ",", ".")) + rng.choice("#$%*&!?-_+=~") * rng.randint(2, 4),
        lambda: pick(up, 1) + pick(low, rng.randint(3, 7)) + pick(num, 2),
        lambda: pick(up, 2) + pick(low, rng.randint(3, 7)),
        lambda: "#" + word() + pick(num, rng.randint(0, 4)),
        lambda: "$" + pick(num, 2) + "." + pick(num, 2),
        lambda: pick(num, rng.randint(1, 5)) + pick("%", rng.randint(0, 1)),
        lambda: pick(low, 2) + pick(num, 1),
        lambda: pick(up, 2) + pick(num, 2),
        lambda: word() + "." + rng.choice(("md", "py", "txt", "com", "json")),
        lambda: word() + "()",
        lambda: word() + "." + pick(num, 2) + "@" + word() + pick(num, 1) + ".example.com",
        lambda: "+" + pick(num, rng.randint(11, 14)),
        lambda: pick(num, 16),
        lambda: f"({pick(num, 3)}) {pick(num, 3)}-{pick(num, 4)}",
        lambda: f"{pick(num, 3)}-{pick(num, 2)}-{pick(num, 4)}",
        lambda: f"20{pick(num, 2)}-{pick(num, 2)}-{pick(num, 2)}T{pick(num, 2)}:{pick(num, 2)}",
        lambda: ".".join(pick("12", 1) + pick(num, 2) for _ in range(4)),
        lambda: "https://www." + word() + ".org/" + word() + "/" + pick(num, 6) + ".html",
        lambda: "-".join(word() for _ in range(3)) + "-" + pick(num, 2),
        lambda: word() + "_" + word() + "_" + pick(num, 3),
        lambda: word() + word() + word() + pick(num, rng.randint(1, 3)),
        lambda: "v" + ".".join(pick(num, 1) for _ in range(3)) + "-" + word() + pick(num, 2),
        lambda: "/usr/lib/" + word() + "/" + word() + pick(num, 1) + ".so." + pick(num, 1),
        lambda: pick(num, 12),
        lambda: "isbn" + pick(num, 13),
        lambda: "report_" + pick(num, 8) + ".pdf",
    )
    leads = (
        "Authorization: Bearer {}", "export API_TOKEN={}", "aws_secret_access_key = {}", '"client_secret": "{}"', "key {}",
        "the credential is {}", "login with {}", "token {}", "{}", "{}", "private key {}", "pass: {}", "auth={}", "secret {} here",
    )
    announced = (
        "password {}", "password is {}", "the password is {}", "the credential is {}", "passwd: {}", "pwd={}", "pass: {}", "login with {}",
        "secret phrase {} here", "secret {} here", "my passphrase is {}", "PASSWORD={}", '"password": "{}"', "auth={}", "sign in with password {}",
    )
    about = (
        "the password is wrong", "the password must be changed", "a secret phrase is needed here", "login with your account", "token of thanks",
        "the credential is checked again", "keep the secret safe", "my passphrase is long", "password required", "the key is on the table",
        "sign in with password or card", "pass the salt", "auth is off", "private access only", "a bearer of news", "secret garden here",
    )
    plain = ("call {}", "see {}", "mail {}", "{}", "{}", "id {}", "at {}", "file {}", "version {}", "card {}", '"{}"', "host={}")
    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            text += " ".join(word() for _ in range(rng.randint(2, 12))) + rng.choice((" ", " ", "\n"))
            kind = rng.random()
            if kind < 0.22:
                body, lead = rng.choice(passwords)(), rng.choice(announced)
                at = len(text) + lead.index("{}")
                spans.append((at, at + len(body)))
                text += lead.format(body)
            elif kind < 0.32:
                text += rng.choice(about)
            elif kind < 0.58:
                body = rng.choice(secrets)()
                if rng.random() < 0.12:  # a block whose tokens stand one after another
                    body = "\n".join(pick(b64, 48) for _ in range(rng.randint(2, 4)))
                lead = rng.choice(leads)
                at = len(text) + lead.index("{}")
                spans.append((at, at + len(body)))
                text += lead.format(body)
            else:
                text += rng.choice(plain).format(rng.choice(others)())
            text += rng.choice((" ", ". ", "\n", ";\n"))
        out.append((text, spans))
    return out


class Vocabulary:
    """Numbers of words, with what the field needs of their tokens; bounded, per process."""

    def __init__(self, tagger: SecretTagger, most: int = 1_000_000):
        self.tagger, self.most = tagger, most
        words = sorted(tagger.context)
        self.context = {w: k for k, w in enumerate(words, 1)}
        # What a known neighbour word gives a token, by place; 0 is any other word.
        self.around = np.stack([np.zeros((len(NEIGHBOURS), 3)), *map(tagger.neighbour_scores, words)])
        self.plain: dict[tuple, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.size = 0
        self.tokens = np.zeros((0, 2), np.int64)  # numbers of the tokens of a word, -1 for none
        self.ends = np.zeros(0, bool)
        self.scores = np.zeros((0, 3))
        self.near = np.zeros(0, np.int32)  # number of the token as a neighbour word
        self.odd = np.zeros(0, bool)

    def numbers(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = list(dict.fromkeys(map(words.__getitem__, missing.tolist())))
            if len(self.known) + len(new) > self.most and self.known:
                self.clear()
                new = list(dict.fromkeys(words))
            self._learn(new)
            found = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return found

    def _score(self, token: str, mark: str, following: str) -> tuple[np.ndarray, bool]:
        """Scores of a token by itself, and whether it is not plain. Plain tokens of the same
        length and variety have the same features, which are looked up once."""
        if not _is_plain(token):
            return self.tagger.field.weights[_hashed(own_features(token, mark, following))].sum(axis=0), True
        n = len(token)
        key = (min(n, 64) // 4, len(set(token)) * 4 // n, mark, following)
        found = self.plain.get(key)
        if found is None:
            found = self.plain[key] = self.tagger.field.weights[_hashed(own_features(token, mark, following))].sum(axis=0)
        return found, False

    def _learn(self, new: list[str]) -> None:
        pairs, scores, odd, near = [], [], [], []
        for word in new:
            first = self.size + len(odd)
            if word.isalpha():
                own = ((word, "-", "-"),)
            elif (bare := word.rstrip(_TRAILING)).isalpha():
                own = ((bare, "-", word[len(bare)]),)
            else:
                own = [(word[t.start : t.end], t.mark, t.following) for t in tokens_of(word)]
            for token, mark, following in own:
                score, strange = self._score(token, mark, following)
                scores.append(score)
                odd.append(strange)
                near.append(self.context.get(token.lower(), 0))
            pairs.append((first, first + 1 if len(own) > 1 else -1))
        at = len(self.known)
        self.known.update(zip(new, range(at, at + len(new)), strict=True))
        self.size += len(odd)
        self.tokens = _grown(self.tokens, at, np.array(pairs, np.int64))
        self.ends = _grown(self.ends, at, np.array([_ends_sentence(w) for w in new], bool))
        self.scores = _grown(self.scores, self.size - len(odd), np.array(scores))
        self.near = _grown(self.near, self.size - len(odd), np.array(near, np.int32))
        self.odd = _grown(self.odd, self.size - len(odd), np.array(odd, bool))


def _grown(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` put behind the first ``used`` rows; the array doubles when it is full."""
    if used + len(more) > len(held):
        room = np.zeros((2 * (used + len(more)), *held.shape[1:]), held.dtype)
        room[:used] = held[:used]
        held = room
    held[used : used + len(more)] = more
    return held


def _ends_sentence(word: str) -> bool:
    return word.rstrip("\"')").endswith((".", "!", "?"))


@dataclass
class SecretTagger:
    """The fitted field and the neighbour words it knows."""

    field: ChainField
    context: frozenset[str]

    def neighbour_features(self, word: str) -> list[list[str]]:
        """Per neighbour place, the features that a known word at that place gives a token."""
        if word not in self.context:
            return [[] for _ in NEIGHBOURS]
        return [[f"w{k}={word}", *([f"k{k}"] if _is_keyword(word) else [])] for k in NEIGHBOURS]

    def neighbour_scores(self, word: str) -> np.ndarray:
        return np.array([self.field.weights[_hashed(f)].sum(axis=0) if f else np.zeros(3) for f in self.neighbour_features(word)])

    @classmethod
    def fitted(cls, texts: list[tuple[str, list[tuple[int, int]]]] | None = None, epochs: int = 60) -> SecretTagger:
        """Learn from labelled files; by default from the template files."""
        texts = training_texts() if texts is None else texts
        seen: Counter[str] = Counter()
        files = []
        for text, spans in texts:
            places = token_places(text)
            own = [neighbour_word(text[a:b]) for a, b, _ in places]
            seen.update(own)
            files.append((text, spans, places, own))
        known = {w for w, n in seen.items() if n >= 8} | _KEYWORDS | {w for w in seen if _is_keyword(w)}
        tagger = cls(ChainField.blank(FEATURES, 3, OPEN), frozenset(known))
        rows: list[list[int]] = []
        labels: list[int] = []
        lengths: list[int] = []
        for text, spans, places, own in files:
            around = [tagger.neighbour_features(w) for w in own]
            features = [own_features(text[a:b], t.mark, t.following) for a, b, t in places]
            of_file = file_features(text, sum(f[1] != "plain" for f in features))
            for i, (start, _, _) in enumerate(places):
                near = [x for j, k in enumerate(NEIGHBOURS) if 0 <= i + k < len(places) for x in around[i + k][j]]
                rows.append(_hashed([*features[i], *near, *of_file]))
                inside = next((s for s in spans if s[0] <= start < s[1]), None)
                labels.append(OUTSIDE if inside is None else BEGIN if start == inside[0] else INSIDE)
            lengths += _text_chains(text).tolist()
        width = max(map(len, rows))
        words = np.array([r + [0] * (width - len(r)) for r in rows], dtype=np.int64)
        tagger.field.fit(words, np.arange(len(words)), np.array(labels), np.array(lengths), epochs=epochs, rate=0.08)
        tagger.field.first[INSIDE] = -1e9
        return tagger

    def surely_outside(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether the best path of a chain is outside throughout, without searching it.

        Each label but outside costs the lead of outside at its token, and can gain on two
        transitions and on the start at most; where every lead is larger than that, no other path
        is better.
        """
        link = self.field.transitions[OPEN]
        gain = 2 * max(0.0, float(link.max() - self.field.transitions[OUTSIDE, OUTSIDE]))
        gain += max(0.0, float(self.field.first.max() - self.field.first[OUTSIDE]))
        lead = scores[:, OUTSIDE] - scores[:, OUTSIDE + 1 :].max(axis=1)
        return np.minimum.reduceat(lead, np.cumsum(lengths) - lengths) > gain

    def labels(self, texts: list[str], vocabulary: Vocabulary) -> list[np.ndarray]:
        """Label of every token of every text, on the best path of its chain."""
        files = [words_and_lines(t) for t in texts]
        numbers = vocabulary.numbers([w for words, _ in files for w in words])
        pairs = vocabulary.tokens[numbers]
        words = np.array([len(own) for own, _ in files], np.int64)
        stops = vocabulary.ends[numbers]
        stops[np.cumsum(words)[words > 0] - 1] = True  # no chain runs on into the next text
        tokens = pairs[pairs >= 0]
        per_word = 1 + (pairs[:, 1] >= 0)
        before = np.concatenate([[0], np.cumsum(per_word)])
        sizes = np.diff(before[np.concatenate([[0], np.cumsum(words)])])
        text_of = np.repeat(np.arange(len(texts)), sizes)
        scores, near = vocabulary.scores[tokens], vocabulary.near[tokens]
        words_near = np.flatnonzero(near)
        for j, k in enumerate(NEIGHBOURS):
            # The word at i is the neighbour at distance k of the token at i - k of the same text.
            inside = words_near[(words_near >= k) & (words_near - k < len(tokens))]
            inside = inside[text_of[inside] == text_of[inside - k]]
            scores[inside - k] += vocabulary.around[near[inside], j]
        odd = np.bincount(text_of, vocabulary.odd[tokens], len(texts))
        of_file = np.array([_hashed(file_features(t, int(n))) for t, n in zip(texts, odd, strict=True)])
        scores += self.field.weights[of_file].sum(axis=1)[text_of]
        chains = chain_lengths([n for _, counts in files for n in counts], stops, per_word)
        path = np.zeros(len(scores), np.int8)
        if len(chains):
            searched = ~self.surely_outside(scores, chains)
            mine = np.repeat(searched, chains)
            path[mine] = self.field.best_path(scores[mine], chains[searched])
        return np.split(path, np.cumsum(sizes)[:-1])

    def spans(self, text: str) -> list[Span]:
        """Spans that Viterbi's path begins and continues; no fixed pattern is consulted."""
        return self.spans_of([text])[0]

    def spans_of(self, texts: list[str]) -> list[list[Span]]:
        vocabulary = vocabulary_of(self)
        out = []
        for at in range(0, len(texts), 64):
            some = texts[at : at + 64]
            for text, path in zip(some, self.labels(some, vocabulary), strict=True):
                found: list[Span] = []
                if path.any():
                    for (start, end, _), label in zip(token_places(text), path, strict=True):
                        if label == BEGIN:
                            found.append(Span("crf", start, end))
                        elif label == INSIDE and found:
                            found[-1] = Span("crf", found[-1].start, end)
                out.append(found)
        return out

    def all_spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Spans of the fixed patterns, and these with tagged ones that no other span covers."""
        return self.all_spans_of([text])[0]

    def all_spans_of(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        out = []
        for text, tagged in zip(texts, self.spans_of(texts), strict=True):
            base = base_spans(text)
            added = [s for s in tagged if not any(b.start <= s.start and s.end <= b.end for b in base)]
            out.append((base, ordered(base + added)))
        return out

    def redacted(self, text: str, mark: str = "[secret]") -> str:
        """The text with every found span replaced by ``mark``."""
        return replaced(text, self.all_spans(text)[1], mark)


def replaced(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    out, at = [], 0
    if spans:
        for s in spans:
            if s.start >= at:
                out += [text[at : s.start], mark]
            at = max(at, s.end)
    return "".join([*out, text[at:]])


def token_places(text: str) -> list[tuple[int, int, Token]]:
    """Start and end of every token of a text, in code points."""
    return [(m.start() + t.start, m.start() + t.end, t) for m in re.finditer(r"\S+", text) for t in tokens_of(m[0])]


def _text_chains(text: str) -> np.ndarray:
    words, counts = words_and_lines(text)
    ends = np.array([_ends_sentence(w) for w in words], bool)
    return chain_lengths(counts, ends, np.array([len(tokens_of(w)) for w in words], np.int64))


def vocabulary_of(tagger: SecretTagger) -> Vocabulary:
    """The vocabulary of a tagger in this process; its tasks share it."""
    mark = zlib.crc32(tagger.field.weights.tobytes())
    return kept(("secrets", mark), lambda: Vocabulary(tagger))


def scan_secrets(docs: DataFrame, tagger: SecretTagger | None = None) -> DataFrame:
    """Spans of secrets in every whole text, one row per input row.

    Returns doc_id, base and spans: arrays of (kind, start, end) in code points, by start, then
    kind. ``spans`` has all, ``base`` those of the fixed patterns. A null text counts as empty
    and has none; repeated rows and null ids give rows of their own; an empty table gives no
    rows; columns besides doc_id and text are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    fitted = tagger or SecretTagger.fitted()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            both = fitted.all_spans_of(batch.column("text").to_pylist())
            lists = [pa.array([[vars(s) for s in x[k]] for x in both], pa.list_(span)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", "base", "spans"])

    array = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select("doc_id", whole().alias("text")).mapInArrow(run, f"doc_id {kind}, base {array}, spans {array}")


def redact_secrets(docs: DataFrame, tagger: SecretTagger | None = None) -> DataFrame:
    """``docs`` with its secrets replaced and n_chars, if there, counted anew; null texts stay null.

    One row per input row, repeated rows included; an empty table stays empty; columns may have
    any name and type.
    """
    fitted = tagger or SecretTagger.fitted()
    at = docs.columns.index("text")
    rows = packed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            fields = list(batch.schema.field(0).type)
            columns = batch.column(0).flatten()
            given = columns[at].to_pylist()
            spans = fitted.all_spans_of([x or "" for x in given])
            texts = [None if x is None else replaced(x, found) for x, (_, found) in zip(given, spans, strict=True)]
            columns[at] = pa.array(texts, fields[at].type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, fields=fields)], names=["row"])

    clean = rows.mapInArrow(run, rows.schema).select("row.*")
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))

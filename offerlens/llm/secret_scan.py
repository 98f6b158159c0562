"""Secret scan: fixed patterns, plus a conditional random field that tags tokens.

The patterns find assignments, access keys and long hexadecimal runs. The field labels the
tokens around anything that could carry a secret (a token with a digit, a long one of mixed
case or with symbols, or a key word) as begin, inside or outside of a secret, from the shape of the token, the tokens next to it
and features of the text; Viterbi decodes each window. A text without such a token is
outside throughout, whatever its length.

Training windows come from a bounded sample of rows (``TRAIN_DOCS``), labelled by the
patterns; each labelled window is used again with its secret replaced by others of the forms
listed below and its key word by others, all drawn from the text's own hash. So the field
marks secrets that no pattern names.

Defined results: a missing text has no spans; repeated rows give equal rows; texts are read
whole, a run of characters of any length in linear time.
"""

import random
import re
from collections.abc import Iterator
from itertools import islice, pairwise
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.crf import Crf
from offerlens.llm.spans import joined, sha256_of

#: Rows that the field is trained on, those with the lowest hash of their id.
TRAIN_DOCS = 3000
#: Texts among them that windows are taken from: so many with a pattern match, and so many without.
TRAIN_TEXTS = 100
#: Tokens to both sides of a candidate that belong to its window.
REACH = 6
LABELS = ("O", "B", "I")
KINDS = ("assign", "access", "hex", "secret")

ASSIGN = re.compile(
    r"(?ia:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Key words that make a window, in lower case.
KEY_WORDS = ("passw", "secret", "token", "api", "bearer", "authorization", "credential", "private", "pwd", "auth_",
             "passphr", "access_key", "access-key")
_TOKEN = re.compile(r"[A-Za-z0-9_+/.-]++|[^\sA-Za-z0-9_+/.-]|=")
_CARRIER = re.compile(r"[0-9]")
_KEYS = re.compile("|".join(KEY_WORDS), re.I | re.A)
#: Long tokens, and what makes one of them a candidate: mixed case or symbols.
_LONG = re.compile(r"[A-Za-z0-9_+/.=-]{16,}+")
_MIXED = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]|[+/_=]")

#: Words that other training windows put before a secret.
OTHER_KEYS = (
    "Bearer", "Authorization: Bearer", "private_key =", "client_secret:", "access_key=", "pwd =", "credential =",
    "auth_token:", "password is", "secret key", "api token", "passphrase =", "the token", "X-Api-Key:",
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, in code points."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Token bounds of the stretches of ``text`` around candidates; overlapping ones are one."""
    spots = [m.start() for m in _CARRIER.finditer(text)]
    spots += [m.start() for m in _KEYS.finditer(text)]
    spots += [m.start() for m in _LONG.finditer(text) if _MIXED.search(text, *m.span())]
    spots.sort()
    if not spots:
        return
    tokens, stretch_end = [], -1
    for spot in spots:
        if spot < stretch_end:
            continue
        begin = _back(text, spot, REACH, max(stretch_end, 0))
        if begin > stretch_end and tokens:
            yield tokens
            tokens = []
        after = 0
        at = max(begin, stretch_end)
        for token in _TOKEN.finditer(text, at):
            tokens.append(token.span())
            stretch_end = token.end()
            if token.start() > spot:
                after += 1
                if _CARRIER.search(token[0]) or _KEYS.search(token[0]):
                    after = 0
                if after >= REACH:
                    break
        else:
            stretch_end = len(text)
    if tokens:
        yield tokens


def _back(text: str, at: int, words: int, floor: int) -> int:
    """The start of the ``words``-th white-space word before the one at ``at``, not before ``floor``."""
    for _ in range(words + 1):
        while at > floor and not text[at - 1].isspace():
            at -= 1
        begin = at
        while at > floor and text[at - 1].isspace():
            at -= 1
        if at <= floor:
            break
    return begin


def _shape(token: str) -> str:
    classes = {"l": any(map(str.islower, token)), "U": any(map(str.isupper, token)), "d": any(map(str.isdigit, token))}
    return "".join(k for k, there in classes.items() if there) + ("s" if re.search(r"[+/_=.-]", token) else "")


def _turns(token: str) -> int:
    """Changes between letters and digits, up to four: many in random strings."""
    kinds = map(str.isdigit, token)
    return sum(1 for _ in islice((a for a, b in pairwise(kinds) if a != b), 4))


_SIGNS = "\"':=@"
#: How harmless strings of digits look: dates and times, versions, numbers with separators.
_PLAIN = re.compile(
    r"(?P<time>\d{4}-\d\d-\d\d([T_ ]?\d\d[:.]?\d\d([:.]?\d\d)?([.,]\d+)?(Z|[+-]\d\d:?\d\d)?)?|\d\d([.,]\d+)?Z|\d\d?[./]\d\d?[./]\d{2,4})"
    r"|(?P<version>v?\d+(\.\d+)+([-+.]?[a-z]+[.\d]*)?)|(?P<number>[0-9.,+()-]+)", re.A
)


def features(text: str, tokens: list[tuple[int, int]], base: int) -> list[list[str]]:
    """Names of the features of each token; ``base`` is the number of pattern matches of the text."""
    words = [text[a:b] for a, b in tokens]
    own = []
    for word in words:
        name = [f"shape:{_shape(word)}", f"len:{min(len(word).bit_length(), 8)}", f"turns:{_turns(word)}"]
        if key := _KEYS.search(word):
            name.append(f"key:{key[0].lower()}")
        if not word[0].isalnum():
            name.append(f"sign:{'//' if word.startswith('//') else word[0] if word[0] in _SIGNS else '?'}")
        if plain := _PLAIN.fullmatch(word):
            name.append(plain.lastgroup if plain.lastgroup == "number" else f"number:{plain.lastgroup}")
        own.append(name)
    file = [f"file:{min(base, 2)}", f"file:{'=' in text}"]
    out = []
    for i, name in enumerate(own):
        row = name + ["bias"] + file
        for step in (-3, -2, -1, 1):
            if 0 <= i + step < len(own):
                row += [f"{step}:{x}" for x in own[i + step] if x[:2] in ("sh", "ke", "si", "nu")]
        out.append(row)
    return out


def labels_of(tokens: list[tuple[int, int]], secrets: list[tuple[int, int]]) -> list[int]:
    """B at the first token of a secret, I at its others."""
    out = []
    for start, end in tokens:
        hit = next((a for a, b in secrets if start < b and end > a), None)
        out.append(0 if hit is None else 1 if not out or start <= hit or not out[-1] else 2)
    return out


def secret_parts(text: str) -> list[tuple[int, int]]:
    """What the patterns hold to be the secret itself: the value of an assignment, or the whole match."""
    parts = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if ":" in text or "=" in text else []
    for a, b, kind in base_spans(text):
        if kind != "assign" and not any(a < d and b > c for c, d in parts):
            parts.append((a, b))
    return sorted(parts)


def _prefix(draw: random.Random) -> str:
    """What issuers put before their tokens: a short name, or two."""
    names = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 6))) for _ in range(draw.randint(1, 2))]
    return "".join(name + draw.choice("-_") for name in names)


def lookalike(draw: random.Random) -> str:
    """Something with digits or mixed case that is no secret."""
    def digits(n: int) -> str:
        return "".join(draw.choices("0123456789", k=n))

    date = f"20{digits(2)}-0{draw.randint(1, 9)}-{draw.randint(10, 28)}"
    time = f"{draw.randint(10, 23)}:{draw.randint(10, 59)}:{draw.randint(10, 59)}"
    word = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 8)))
    uuid = "-".join("".join(draw.choices("0123456789abcdef", k=k)) for k in (8, 4, 4, 4, 12))
    return draw.choice((
        digits(draw.randint(1, 16)), f"+1 ({digits(3)}) 555-0100", f"{draw.randrange(256)}.{draw.randrange(256)}.0.1",
        f"{word}{digits(2)}@mail.example.com", date, time, f"{date}T{time}Z", f"{date}T{time}.{digits(3)}+0{draw.randint(0, 9)}:00",
        f"{date} {time}", f"v{draw.randrange(9)}.{draw.randrange(30)}.{draw.randrange(9)}", f"{word}-{digits(1)}.{digits(2)}.{digits(1)}.tar.gz",
        f"{word}_{date}.csv", f"get{word.title()}By{word.title()}Id{digits(1)}", f"https://{word}.example.com/{word}/{digits(5)}?page={digits(1)}",
        f"/usr/lib/{word}/{word}{digits(1)}/{word}.so", uuid, f"ISBN 978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}", f"{digits(2)}/{digits(2)}/20{digits(2)}",
    ))


def random_token(draw: random.Random) -> str:
    letters = "abcdefghijklmnopqrstuvwxyz"
    return "".join(draw.choices(letters + letters.upper() + "0123456789", k=draw.randint(16, 40)))


def random_secret(draw: random.Random) -> str:
    """A secret of one of the usual forms."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mixed = letters + letters.upper() + "0123456789"
    form = draw.randrange(7)
    if form == 0:
        return "".join(draw.choices("0123456789abcdef", k=draw.choice((16, 20, 32, 40, 64))))
    if form == 1:
        return "AKIA" + "".join(draw.choices(letters.upper() + "0123456789", k=16))
    if form == 2:
        return "".join(draw.choices(mixed + "+/", k=draw.randint(20, 60)))
    if form == 3:
        return _prefix(draw) + random_token(draw)
    if form == 5:
        return "".join(draw.choices(mixed, k=draw.randint(8, 18)))
    if form == 4:
        return "".join(draw.choices(letters, k=draw.randint(3, 8))) + "".join(draw.choices("0123456789", k=draw.randint(2, 5)))
    return "-".join("".join(draw.choices("0123456789abcdef", k=k)) for k in (8, 4, 4, 4, 12))


def examples(text: str, limit: int = 4) -> list[tuple[list[list[str]], list[int]]]:
    """Training sequences of a text: its windows as they are, and with other secrets put in."""
    out, draw = [], random.Random(crc32(text.encode("utf-8", "replace")))

    def add(part: str, secrets: list[tuple[int, int]]) -> None:
        base = len(base_spans(part))
        for tokens in windows(part):
            out.append((features(part, tokens[:60], base), labels_of(tokens[:60], secrets)))

    known = secret_parts(text)
    for a, b in known[:limit]:
        part = text[max(0, a - 150) : b + 100]
        add(part, secret_parts(part))
    words = text[:4000].split()
    for _ in range(2):
        if len(words) > 12:
            at = draw.randrange(len(words) - 10)
            before, after = " ".join(words[at : at + 5]), " ".join(words[at + 5 : at + 10])
            quote = draw.choice(("", "", '"', "'"))
            head = f"{before} {draw.choice(OTHER_KEYS)} {quote}"
            secret = random_secret(draw)
            add(f"{head}{secret}{quote} {after}", [(len(head), len(head) + len(secret))])
            for _ in range(3):
                add(f"{before} {lookalike(draw)} {after}", [])
            user, host = (draw.choice(words[at : at + 10]) for _ in range(2))
            head = f"{before} {draw.choice(('https', 'postgres', 'amqp', 'mongodb', 'ftp'))}://{user}:"
            word = random_secret(draw)
            add(f"{head}{word}@{host}.example.com/{user} {after}", [(len(head), len(head) + len(word))])
            head = f"{before} Server={host};{draw.choice(('Pwd', 'Password', 'pwd', 'AccountKey', 'PASSWD'))}="
            word = random_secret(draw)
            add(f"{head}{word};Database={user} {after}", [(len(head), len(head) + len(word))])
            token = _prefix(draw) + random_token(draw)
            add(f"{before} {token} {after}", [(len(before) + 1, len(before) + 1 + len(token))])
    return out


def train(texts: list[str]) -> Crf:
    """The field, from texts labelled by the patterns."""
    hit = [t for t in texts if base_spans(t)][:TRAIN_TEXTS]
    plain = [t for t in texts if not base_spans(t)][:TRAIN_TEXTS]
    return Crf(LABELS).fit([e for t in hit + plain for e in examples(t)])


def found_spans(text: str, model: Crf, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Secrets the field tags that touch no pattern match."""
    out = []
    for tokens in windows(text):
        path = model.decode(model.scores(features(text, tokens, len(base))))
        spans: list[list[int]] = []
        for (start, end), label in zip(tokens, path, strict=True):
            if label == 1 or label == 2 and not spans:
                spans.append([start, end])
            elif label == 2 and spans[-1][1] == start:
                spans[-1][1] = end
            elif label == 2:
                spans.append([start, end])
        out += [(a, b, "secret") for a, b in spans]
    return _apart(out, base)


def _apart(found: list[tuple[int, int, str]], base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Those of ``found`` that touch none of ``base``; both are in order, and no two of ``found`` overlap."""
    kept, at, reached = [], 0, -1
    for a, b, kind in found:
        while at < len(base) and base[at][0] < b:
            reached = max(reached, base[at][1])
            at += 1
        if reached <= a:
            kept.append((a, b, kind))
    return kept


def fit_on(docs: DataFrame, n: int = TRAIN_DOCS) -> Crf:
    """Train on the ``n`` documents with the lowest hash of their id; of each only what surrounds a match and
    4,000 characters leave the executors."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = docs.join(F.broadcast(ids), "doc_id").where("text is not null").select("doc_id", F.col("text").cast("string"))

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for doc_id, text in zip(batch.doc_id, batch.text, strict=True):
                spots = base_spans(text)[:2]
                part = " ".join(text[max(0, a - 300) : b + 300] for a, b, _ in spots) or text[:4000]
                kept.append((doc_id, bool(spots), part))
            yield pd.DataFrame(kept, columns=["doc_id", "hit", "part"])

    cut = sample.mapInPandas(parts, "doc_id long, hit boolean, part string")
    order = [F.xxhash64("doc_id"), "doc_id", "part"]
    rows = cut.where("hit").orderBy(*order).limit(TRAIN_TEXTS).collect() + cut.where("not hit").orderBy(*order).limit(TRAIN_TEXTS).collect()
    return train([row.part for row in rows])


def scan(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_secret, base_sha256, spans) of every row of ``docs``.

    ``spans`` lists kind:start:end in code points, comma-joined, those of the patterns and
    those the field adds.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch.text:
                text = text or ""
                base = base_spans(text)
                more = found_spans(text, model, base)
                counts = [sum(kind == k for _, _, kind in base) for k in KINDS[:3]]
                out.append((*counts, len(more), sha256_of(joined(base)), joined(sorted(
                    base + more, key=lambda s: (s[0], KINDS.index(s[2]))))))
            made = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "n_secret", "base_sha256", "spans"])
            made.insert(0, "doc_id", batch.doc_id.array)
            yield made

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(
        rows, "doc_id long, n_assign long, n_access long, n_hex long, n_secret long, base_sha256 string, spans string"
    )

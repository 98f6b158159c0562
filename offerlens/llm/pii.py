"""Personal data: fixed patterns, and contextual extraction bootstrapped from what they find.

Entities found by the fixed patterns are seeds. The words next to them are lexical patterns
(the word before, the two words before, the word behind). Patterns and the identifiers that
stand in them, seeds or not, form a graph, which Spark scores in rounds: a pattern is as good
as the mean score of its identifiers (with one bad one assumed), an identifier as good as its
patterns together (noisy or); seeds keep 1. Identifiers that no fixed pattern covers are
reported where their own score and that of a well-supported pattern are high. Words that
mostly stand next to other things, as function words do, are no patterns: of their places in
all texts, with identifiers or without, a fair share must have an identifier.

Texts are scanned twice; the first scan gives a table of identifiers and their context, a
small part of the corpus, the second the places of these contexts' words, added up within
each task. A bitmap of bounded size lets the second scan skip most other words; the join
that follows is exact. All joins are on pattern or identifier after both have been made
distinct. A frequent word before many identifiers is one hot pattern: its rows are
pre-aggregated, and the planner splits it when joining.

Defined results: a missing text has no spans; repeated rows give equal rows; texts are read
whole, and runs of any length in linear time; an empty table gives an empty one.
"""

import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import words as W
from offerlens.llm.spans import joined, sha256_of
from offerlens.staging import drop_stage, stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: Scores from which patterns and identifiers count, and distinct identifiers a pattern needs.
PATTERN_SCORE, IDENTIFIER_SCORE, SUPPORT = 0.6, 0.7, 3
#: Share of a pattern's places that have an identifier.
SELECTIVE = 0.3
#: Bits of the bitmap of patterns, at most, and patterns that a task counts at a time.
BITMAP, COUNTED = 1 << 27, 100_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")
#: White-space words that carry a digit or an at sign; found from there, not from the start of a run.
_MARK = re.compile(r"[0-9@]")
_EDGE = "\"'()[]{}<>,;:!?.*#|"
#: Digits with blanks, brackets, dashes and single dots between them, not begun within a word.
_RUN = re.compile(r"(?<!\w)\(?[0-9](?:(?:[\x20()\[\]-]*+|\.)[0-9])*+")
#: What may stand between two fields without a blank, and the words of contexts.
_CUT = re.compile(r"[\"',;:]")
_PIECE = re.compile(r"[^\s\"',;:]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, at sign and domain, found from the at sign."""
    out, last = [], 0
    for domain in _DOMAIN.finditer(text):
        start = domain.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < domain.start():
            out.append((start, domain.end()))
            last = domain.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind as listed."""
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                    found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _DIGITS.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _EDGE:
        a += 1
    while b > a and text[b - 1] in _EDGE:
        b -= 1
    return a, b


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Maximal runs of digits and what may stand between them, of any length; an opening bracket needs its closing one."""
    for m in _RUN.finditer(text):
        a, b = m.span()
        if b < len(text) and (text[b].isalnum() or text[b] in "_@"):
            while b > a and text[b - 1].isdigit():
                b -= 1
            while b > a and not text[b - 1].isdigit():
                b -= 1
        if a < b and text[a] == "(" and ")" not in text[a:b]:
            a += 1
        if a < b:
            yield a, b


def _words(text: str) -> Iterator[tuple[int, int]]:
    """White-space words that carry a digit or an at sign, and their pieces between quotes, commas and colons."""
    end = 0
    for mark in _MARK.finditer(text):
        if mark.start() < end:
            continue
        start, end = mark.start(), mark.end()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        a, b = _trimmed(text, start, end)
        cut = _CUT.search(text, a, b)
        if not cut or "@" not in text[a:b]:
            yield a, b
        if cut:
            for m in _PIECE.finditer(text, a, b):
                yield _trimmed(text, *m.span())


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Identifier-like runs, words and pieces of words outside all base spans, longer ones first where they begin:
    with an at sign, or five digits and more. Which of those that overlap is meant is left to the scores."""
    if not _MARK.search(text):
        return []
    found = sorted({*_runs(text), *_words(text)}, key=lambda s: (s[0], -s[1]))
    out, spans = [], iter(base)
    span, last = next(spans, None), 0
    for a, b in found:
        while span is not None and span[0] < a:
            last = max(last, span[1])
            span = next(spans, None)
        if last > a or span is not None and span[0] < b:
            continue
        if "@" in text[a:b] or sum(c.isdigit() for c in text[a:b]) >= 5:
            out.append((a, b))
    return out


def kinds_like(value: str) -> list[str]:
    """Kinds that an identifier of this shape could be."""
    if "@" in value:
        return ["email"]
    digits = sum(c.isdigit() for c in value)
    if 2 * digits < len(value):
        return []
    out = ["ip"] if value.count(".") + value.count(":") >= 2 else []
    return out + ["card"] * (digits >= 12) + ["phone"] * (7 <= digits <= 15)


def _plain(word: str) -> str:
    return word.strip(_EDGE).lower() or word


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span, from at most 80 characters to either side."""
    before = [_plain(word) for word in _PIECE.findall(text[max(0, start - 80) : start])[-2:]]
    after = _PIECE.findall(text[end : end + 80])
    out = [f"1< {before[-1]}"] if before else []
    if len(before) == 2:
        out.append(f"2< {before[0]} {before[1]}")
    if after:
        out.append(f"> {_plain(after[0])}")
    return out


def places(text: str, wanted: Callable[[str], bool]) -> Counter:
    """How often the words of each wanted pattern occur in ``text``; a pattern of two words needs that of its second."""
    words = [_plain(word) for word in _PIECE.findall(text)]
    out, ends = Counter(), set()
    for word, n in Counter(words).items():
        if wanted(f"1< {word}"):
            out[f"1< {word}"] = n
            ends.add(word)
        if wanted(f"> {word}"):
            out[f"> {word}"] = n
    pairs = Counter(pair for pair in zip(words, words[1:], strict=False) if pair[1] in ends)
    for (a, b), n in pairs.items():
        if wanted(pattern := f"2< {a} {b}"):
            out[pattern] = n
    return out


_FOUND = (
    "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "base array<struct<start:int,end:int,kind:int>>, "
    "beside array<string>, "
    "seen array<struct<start:int,end:int,value:string,kinds:array<string>,seed:boolean,run:int,patterns:array<string>>>"
)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text in batch.text:
            base = base_spans(text)
            counts = [sum(kind == k for _, _, kind in base) for k in KINDS]
            found = [(a, b, [kind], True, a) for a, b, kind in base]
            run = end = -1  # the start and end of the longest candidate that others overlap
            for a, b in candidates(text, base):
                if kinds := kinds_like(text[a:b]):
                    run, end = (run, end) if a < end else (a, b)
                    found.append((a, b, kinds, False, run))
            seen = [
                {"start": a, "end": b, "value": text[a:b].lower(), "kinds": kinds, "seed": seed, "run": run,
                 "patterns": contexts(text, a, b)}
                for a, b, kinds, seed, run in found
            ]
            beside = [pattern for _, pattern in {(s["start"], pattern) for s in seen for pattern in s["patterns"]}]
            spans = [{"start": a, "end": b, "kind": KINDS.index(kind)} for a, b, kind in base]
            out.append((*counts, sha256_of(joined(base)), spans, beside, seen))
        made = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "beside", "seen"])
        made.insert(0, "doc_id", batch.doc_id.array)
        made.insert(1, "text_key", batch.text_key.array)
        yield made


def _places_in(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, there): the places in all ``texts`` of the words of ``patterns``, which are distinct."""
    bits = min(BITMAP, 1 << max(16, (16 * patterns.count()).bit_length()))
    place = F.crc32(F.col("pattern").cast("binary")).bitwiseAND(F.lit(bits - 1))
    spots = patterns.select(F.shiftright(place, 3).alias("byte"), (place % 8).cast("int").alias("bit"))
    rows = spots.groupBy("byte").agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("bits")).toArrow()
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    bitmap[rows.column("byte").to_numpy()] = rows.column("bits").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap, counts = shared.value, Counter()

        def wanted(pattern: str) -> bool:
            at = crc32(pattern.encode()) & (bits - 1)
            return bool(bitmap[at >> 3] >> (at & 7) & 1)

        for batch in batches:
            for text in batch.text:
                counts.update(places(text, wanted))
                if len(counts) > COUNTED:
                    yield pd.DataFrame(counts.items(), columns=["pattern", "times"])
                    counts.clear()
        yield pd.DataFrame(counts.items(), columns=["pattern", "times"])

    counted = texts.select("text").mapInPandas(count, "pattern string, times long")
    there = counted.groupBy("pattern").agg(F.sum("times").alias("there")).join(patterns, "pattern")
    there = stage(there, "pii-places")
    shared.unpersist()
    return there


def scored(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scores of the pattern-identifier graph.

    ``edges`` (pattern, value, kind) are distinct; ``seeds`` (value, kind) too. Returns patterns
    (pattern, kind, score, support) and identifiers (value, kind, score), both staged.
    """
    identifiers = stage(seeds.withColumn("score", F.lit(1.0)), "pii-identifiers")
    patterns = None
    for _ in range(rounds):
        if patterns is not None:
            drop_stage(patterns)
        known = F.coalesce("score", F.lit(0.0))
        patterns = stage(
            edges.join(identifiers, ["value", "kind"], "left").groupBy("pattern", "kind").agg(
                (F.sum(known) / (F.count(F.lit(1)) + 1)).alias("score"), F.sum((known > 0).cast("long")).alias("support")
            ).where("score > 0"), "pii-patterns",
        )
        doubt = F.log(1 - F.least("score", F.lit(0.999)))
        reached = edges.join(patterns.where(f"support >= {SUPPORT}"), ["pattern", "kind"]).groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(doubt))).alias("score")
        )
        following = stage(
            reached.union(seeds.select("value", "kind", F.lit(1.0))).groupBy("value", "kind").agg(F.max("score").alias("score")),
            "pii-identifiers",
        )
        drop_stage(identifiers)
        identifiers = following
    return patterns, identifiers


def _uncovered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of candidates that overlap, by start and the longer first, those that begin within no kept one."""
    for batch in batches:
        rows = []
        for doc_id, text_key, _, made in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            end = -1
            for s in made:
                if s["start"] >= end:
                    end = -s["back"]
                    rows.append((doc_id, text_key, s["start"], end, s["kind"]))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "text_key", "start", "end", "kind"]
        )


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found) of every row of ``docs``.

    The counts and ``base_sha256`` are those of the fixed patterns; ``spans`` lists all spans as
    kind:start:end in code points, ``n_found`` of them from context.
    """
    texts = docs.select(F.col("doc_id").cast("long"), W.text_of(F.col(text)).alias("text")).withColumn(
        "text_key", F.xxhash64("text")
    )
    found = stage(texts.mapInPandas(_scan, _FOUND), "pii-found")
    seen = found.where(F.size("seen") > 0).select("doc_id", "text_key", F.explode("seen").alias("s")).select(
        "doc_id", "text_key", "s.*"
    )
    seen = seen.withColumn("kind", F.explode("kinds")).drop("kinds").distinct()
    seen = stage(seen, "pii-seen")
    links = seen.withColumn("pattern", F.explode("patterns")).drop("patterns")
    used = stage(
        found.select(F.explode("beside").alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("used")), "pii-used"
    )
    there = _places_in(texts, used.select("pattern"))
    # Words that a cut at 80 characters has shortened have no places of their own.
    selective = used.join(there, "pattern", "left").where(
        F.col("used") >= SELECTIVE * F.coalesce("there", "used")
    ).select("pattern")
    selective = stage(selective, "pii-selective")
    links = stage(links.join(selective, "pattern"), "pii-links")
    edges = stage(links.select("pattern", "value", "kind").distinct(), "pii-edges")
    patterns, identifiers = scored(edges, seen.where("seed").select("value", "kind").distinct())

    good = patterns.where((F.col("score") >= PATTERN_SCORE) & (F.col("support") >= SUPPORT)).select("pattern", "kind")
    sure = identifiers.where(F.col("score") >= IDENTIFIER_SCORE).withColumnRenamed("score", "sure")
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    new = (
        links.where("not seed").join(good, ["pattern", "kind"]).join(sure, ["value", "kind"])
        .groupBy("doc_id", "text_key", "run", "start", "end")
        .agg(F.max(F.struct("sure", (-number).alias("kind"))).alias("best"))
        .groupBy("doc_id", "text_key", "run")
        .agg(F.sort_array(F.collect_list(F.struct("start", (-F.col("end")).alias("back"), (-F.col("best.kind")).alias("kind")))).alias("made"))
        .mapInArrow(_uncovered, "doc_id long, text_key long, start int, end int, kind int")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("start", "end", "kind")).alias("new"))
    )
    none = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    both = W.join_same(found.drop("seen", "beside"), new, ["doc_id", "text_key"], "left").withColumn("new", F.coalesce("new", none))
    ordered = F.sort_array(F.transform(
        F.concat("base", "new"), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    ))
    names = F.array(*map(F.lit, KINDS))
    spans = F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    return both.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"),
        F.size("new").cast("long").alias("n_found"),
    )

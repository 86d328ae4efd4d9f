"""Secret scans: candidate strings from whole texts, false positives removed by a random forest trained on labelled findings."""

from __future__ import annotations

import random
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, materialised, shipped, with_whole_ids

#: A token is a run without white space, quotes, brackets, commas, semicolons and bars; what punctuation may stand at its ends; least length.
TOKEN, LONG = (re.compile(r"[^\s\"'`<>(){}\[\],;|]" + n) for n in ("+", "{8,}"))
ENDS, LEAST = ".:!?*#$%&~", 8
#: A plain word of fewer characters is no candidate, unless a marker and an assignment stand before it.
PLAIN = 24
_MARK = r"(?i)(?:key|token|secret|passw\w*|pwd|pass|auth\w*|bearer|credential\w*)[\"']?\s*(?:[=:]|\bis\b)\s*[\"']?"
MARK, MARKED = re.compile(_MARK), re.compile(_MARK + "$")
MARKERS = ("key", "token", "secret", "pass", "pwd", "auth", "bearer", "credential")
#: Least length of a token after a marker.
MARKED_LEAST = 4
#: Characters of context on either side.
BEFORE, AFTER = 48, 24
#: Words near a finding that speak for and against a secret.
FOR = re.compile(r"(?i)key|token|secret|passw|passphrase|pwd|auth|bearer|credential|private|signing|access")
AGAINST = re.compile(r"(?i)\b(?:commit|sha\d*|md5|checksum|digest|etag|version|release|uuid|guid|order|invoice|phone|call|tel|fax|mail|ip|page|isbn|build|example|ticket|tracking)\b")
FEATURES = [
    "length", "switches", "repeats", "digits", "uppers", "others", "kinds", "entropy", "cover", "longest_word", "segments", "word_segments", "path", "extension", "mail",
    "numeric", "hexadecimal", "grouped", "assigned", "quoted", "good", "bad", "near_good",
]
#: Words of the dictionary and how often each must occur; distinct words a task counts before it hands them on.
WORDS, OFTEN, COUNTED = 50_000, 3, 200_000
#: Frequencies told apart when the dictionary is cut.
TOP = 1_000_000
#: Longest word looked up in a candidate, and characters of a candidate whose letters are looked up (longer ones by parts of that size).
LONGEST = 16
#: Trees, their depth, findings trained on at most, and the chance from which a finding is a secret.
TREES, DEPTH, FINDINGS, THRESHOLD = 60, 10, 20_000, 0.5
_WORD = re.compile(r"[^\W\d_]{3,24}")


def found_in(text: str) -> Iterator[tuple[int, str]]:
    """Begin and value of every candidate of a text: each token of LEAST characters or more that isn't one plain word, and each that stands after a marker and an assignment.

    A plain word has letters alone, of one case or with a capital at its head, and fewer than PLAIN of them. An assignment inside a token parts
    its name from its value.
    """
    spots = {m.start(): m[0] for m in LONG.finditer(text) if not _plain(m[0])}
    low = text.lower()
    if any(x in low for x in MARKERS):
        for m in MARK.finditer(text):
            after = TOKEN.match(text, m.end())
            if after and (not m.end() or not TOKEN.match(text[m.end() - 1])):
                spots[after.start()] = after[0]
    for at in sorted(spots):
        value = spots[at]
        cut = _NAMED.match(value)
        if cut:
            value, at = value[cut.end() :], at + cut.end()
        inner = value.lstrip(ENDS)
        at, value = at + len(value) - len(inner), inner.rstrip(ENDS)
        if len(value) >= LEAST and not _plain(value) or len(value) >= MARKED_LEAST and MARKED.search(text[max(0, at - BEFORE) : at]):
            yield at, value


_NAMED = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*[=:](?=[^=:/])")


def _plain(value: str) -> bool:
    """Whether it is one plain word."""
    return value.isalpha() and len(value) < PLAIN and (value.islower() or value.istitle() or value.isupper())


FOUND = "doc_id long, nil boolean, begin long, value string, before string, after string"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: list[str] | None = None) -> DataFrame:
    """found_in() every whole text: doc_id, begin (in characters), value, before, after, and with a dictionary _features, the FEATURES in order.

    Null and empty texts have none; rows that repeat have theirs repeated. The features come from the same pass.
    """
    spark = docs.sparkSession
    shipped(spark)
    shared = spark.sparkContext.broadcast(None if words is None else set(words))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            rows = []
            for doc_id, nil, text in zip(batch["doc_id"].tolist(), batch["nil"].tolist(), batch["text"].tolist(), strict=True):
                for a, value in found_in(text or ""):
                    z = a + len(value)
                    rows.append((doc_id, nil, a, value, text[max(0, a - BEFORE) : a], text[z : z + AFTER]))
            out = pd.DataFrame(rows, columns=["doc_id", "nil", "begin", "value", "before", "after"]).astype({"doc_id": "int64", "begin": "int64", "nil": "bool"})
            if known is not None:
                out["_features"] = pd.Series([features_of(v, b, a, known) for v, b, a in zip(out["value"], out["before"], out["after"], strict=True)], dtype=object)
            yield out

    found = with_whole_ids(docs, id_col, text_col).mapInPandas(find, FOUND + (", _features array<double>" if words is not None else ""))
    return found.withColumn("doc_id", F.when(~F.col("nil"), F.col("doc_id"))).drop("nil")


def dictionary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The most frequent words of all whole texts, lower-cased: WORDS of them at most, which occur OFTEN or more. Of words as frequent as the first one too many, none is taken.

    The cut comes from the numbers of words by frequency, so no more than the dictionary ever reaches the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch["text"].tolist():
                held.update(_WORD.findall((text or "").lower()))
                if len(held) > COUNTED:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = materialised(rows.where(F.col("n") >= OFTEN), "words")
    # frequencies from TOP on are one row
    held, cut = 0, OFTEN
    for n, words in sorted(map(tuple, rows.groupBy(F.least("n", F.lit(TOP)).alias("n")).count().collect()), reverse=True):
        held += words
        if held > WORDS:
            cut = n + 1
            break
    out = sorted(r[0] for r in rows.where(F.col("n") >= cut).select("word").collect())
    dropped(rows)
    return out


def covered(value: str, words: set[str]) -> tuple[int, int, int]:
    """Letters of a value, those inside its words (longest first, from the left), and the longest word."""
    letters = inside = longest = 0
    parts = re.findall(r"[^\W\d_]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value))
    for part in parts:
        low, k = part.lower(), 0
        letters += len(low)
        while k < len(low):
            size = next((n for n in range(min(LONGEST, len(low) - k), 2, -1) if low[k : k + n] in words), 0)
            inside, longest = inside + size, max(longest, size)
            k += size or 1
    return letters, inside, longest


def features_of(value: str, before: str, after: str, words: set[str]) -> list[float]:
    """FEATURES of a finding: its length, character transitions, dictionary coverage, path and neighbouring words."""
    n = max(len(value), 1)
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]
    letters, inside, longest = covered(value, words)
    segments = [s for s in re.split(r"[/\\._:@+=-]+", value) if s]
    counts = np.array(list(Counter(value).values()), float) / n
    last = segments[-1] if segments else ""
    head = before.rsplit("\n", 1)[-1]
    return [
        float(min(n, 200)),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
        1 - len(set(value)) / n,
        kinds.count(0) / n,
        kinds.count(2) / n,
        kinds.count(3) / n,
        float(len(set(kinds))),
        float(-(counts * np.log2(counts)).sum()) if n > 1 else 0.0,
        inside / max(letters, 1),
        float(longest),
        float(min(len(segments), 20)),
        sum(s.isalpha() and (s.lower() in words) for s in segments) / max(len(segments), 1),
        float("/" in value or "\\" in value or value.startswith("www.")),
        float(2 <= len(last) <= 4 and last.isalpha() and len(segments) > 1 and "." in value),
        float(bool(re.fullmatch(r"[^@\s]+@[^@\s]+\.[A-Za-z]{2,}", value))),
        float(bool(re.fullmatch(r"[\d.+:/TZ-]+", value))),
        float(bool(re.fullmatch(r"(0x)?([0-9a-f-]+|[0-9A-F-]+)", value)) and any(c.isdigit() for c in value)),
        float(bool(re.fullmatch(r"[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}", value))),
        float(bool(re.search(r"[=:]\s*[\"']?$|\bis\s+[\"']?$", head))),
        float(head.endswith(('"', "'", "`"))),
        float(len(FOR.findall(head))),
        float(len(AGAINST.findall(head[-24:] + " " + after[:12]))),
        float(bool(FOR.search(head[-20:]))),
    ]


def labelled_findings(words: list[str], n: int = 6000, seed: int = 5) -> list[tuple[str, str, str, int]]:
    """Labelled findings (value, before, after, label) made from a seed where no labelled ones are given, in words of the corpus.

    Secrets are random strings over several alphabets in the places where they leak: assignments of code, shell, JSON and YAML, headers,
    addresses with a password, prose. The others are hard: words of the corpus joined as identifiers, paths, files and addresses; numbers,
    dates, phones, versions; and random strings that are public by what stands beside them (digests, revisions, numbers of things).
    """
    rng = random.Random(seed)
    plain = [w for w in words if w.isalpha()] or ["lorem", "ipsum", "dolor", "amet"]
    word = lambda: rng.choice(plain)
    text = lambda chars, low, high: "".join(rng.choice(chars) for _ in range(rng.randint(low, high)))
    prose = lambda: " ".join(word() for _ in range(rng.randint(1, 7)))
    alnum, hexed, wide = string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_letters + string.digits + "+/"
    name = lambda: rng.choice(["", word() + "_", word() + "-", word()[:3].upper() + "_"]) + rng.choice(["key", "api_key", "apikey", "token", "secret", "password", "passwd", "pwd", "auth", "access_token", "client_secret", "SECRET", "TOKEN", "PASSWORD", "privateKey"])
    thing = lambda: rng.choice([word(), "commit", "sha1", "sha256", "md5", "checksum", "digest", "etag", "uuid", "order", "revision", "build", "version", "ticket"])

    def given(label: str) -> str:
        q = rng.choice(["", '"', "'"])
        return rng.choice([f"{label}={q}", f"{label} = {q}", f"{label}: {q}", f'"{label}": "', f"--{label} ", f"export {label}={q}", f"{label} is {q}", f"{label} {q}"])

    def secret() -> tuple[str, str]:
        kind = rng.randrange(8)
        if kind == 0:
            return text(hexed, 24, 64), given(name())
        if kind == 1:
            return text(wide, 20, 88) + rng.choice(["", "=", "=="]), given(name())
        if kind == 2:
            return rng.choice(["", text(string.ascii_lowercase, 2, 5) + rng.choice("_-")]) + text(alnum, 20, 44), rng.choice([given(name()), prose() + " ", "Authorization: Bearer "])
        if kind == 3:
            return text(string.ascii_uppercase + string.digits, 16, 32), rng.choice([given(name()), prose() + " "])
        if kind == 4:
            base = list(word().capitalize() if rng.random() < 0.5 else text(alnum, 6, 12))
            for _ in range(rng.randint(2, 5)):
                base.insert(rng.randrange(len(base) + 1), rng.choice("!@#$%^&*?0123456789"))
            return "".join(base) + rng.choice(string.ascii_letters), given(rng.choice(["password", "passwd", "pwd", "pass", "PASSWORD", name()]))
        if kind == 5:
            return ".".join(text(alnum + "_-", low, 2 * low) for low in (18, 30, 30)), rng.choice(["Bearer ", given("token"), prose() + " "])
        if kind == 6:
            return f"{word()}:{text(alnum, 10, 20)}@{word()}.{word()}", f"{rng.choice(['postgres', 'mysql', 'amqp', 'https'])}://"
        return text(string.ascii_letters, 20, 60), given(name())

    def harmless() -> tuple[str, str]:
        kind = rng.randrange(14)
        digits = string.digits
        if kind == 0:
            return text(hexed, 32, 64)[: rng.choice([32, 40, 64])], f"{prose()} {thing()}{rng.choice([' ', ': ', ' = '])}"
        if kind == 1:
            return "-".join(text(hexed, k, k) for k in (8, 4, 4, 4, 12)), f"{prose()} {rng.choice([word(), 'uuid', 'order', 'id', 'ticket'])}{rng.choice([' ', ': ', '='])}"
        if kind == 2:
            return text(digits, 8, 20), prose() + rng.choice([" ", " order ", " phone: ", " no. ", " isbn "])
        if kind == 3:
            return f"{word()}.{text(alnum, 1, 3)}@{word()}{text(digits, 0, 2)}.{rng.choice(['com', 'org', 'example.com', 'net'])}", prose() + rng.choice([" ", " mail: ", " contact "])
        if kind == 4:
            return "/".join([rng.choice(["", "usr", "var", word()]), word(), word(), word() + rng.choice(["", text(digits, 1, 3)]) + rng.choice(["", ".py", ".json", ".html", ".txt"])]), prose() + " "
        if kind == 5:
            return rng.choice(["_", "-", "", "."]).join([word(), word().capitalize(), word(), rng.choice(["", text(digits, 1, 4)])]), rng.choice([prose() + " ", given(word()), given(name())])
        if kind == 6:
            return ".".join(text(digits, 1, 3) for _ in range(4)), prose() + rng.choice([" ", " ip ", " host: "])
        if kind == 7:
            return rng.choice(["+", ""]) + "-".join(text(digits, k, k) for k in rng.choice([(2, 3, 7), (3, 4), (4, 2, 2), (3, 3, 4)])), prose() + rng.choice([" ", " phone ", " call ", " on "])
        if kind == 8:
            return f"20{text(digits, 2, 2)}-{text('01', 2, 2)}-{text('012', 2, 2)}T{text(digits, 2, 2)}:{text('012345', 2, 2)}:00Z", prose() + " "
        if kind == 9:
            return f"//{word()}.{word()}.com/{word()}/{word()}-{word()}" + rng.choice(["", f"?{word()}={text(digits, 1, 5)}"]), rng.choice(["https:", "http:"])
        if kind == 10:
            return rng.choice(["${" + word(), "your-" + word() + "-here", "<" + word(), "x" * rng.randint(8, 20), "*" * 3 + word() * 2, f"os.environ.{word()}", f"example_{word()}", "changeme"]).strip("${<*"), given(name())
        if kind == 11:
            return (word() + word() + word())[: rng.randint(24, 40)].ljust(24, "a"), prose() + " "
        if kind == 12:
            return f"v{text(digits, 1, 2)}.{text(digits, 1, 2)}.{text(digits, 1, 3)}-{word()}", prose() + rng.choice([" ", " version ", " release "])
        return rng.choice("!#%&*$").join([word(), word()]) + rng.choice(["***", "$$$", "###", ""]), prose() + " "

    out = []
    for k in range(n):
        value, before = (secret if k % 2 else harmless)()
        close = before[-1] if before[-1:] in ('"', "'") else ""
        out.append((value, f"{prose()}{rng.choice([' ', chr(10)])}{before}", f"{close}{rng.choice([' ', chr(10), ', ', '.'])}{prose()}", k % 2))
    return out


def trained(spark: SparkSession, words: list[str], findings: DataFrame | None = None, seed: int = 5) -> RandomForestClassificationModel:
    """The forest for labelled findings (value, before, after, label), FINDINGS of them at most; without any, for labelled_findings() in these words."""
    shipped(spark)
    if findings is None:
        findings = spark.createDataFrame(labelled_findings(words, seed=seed), "value string, before string, after string, label int")
    known, rows = set(words), findings.where("label in (0, 1)").orderBy(F.xxhash64("value", "before", "after")).limit(FINDINGS).collect()
    rows = [(float(r["label"]), features_of(r["value"] or "", r["before"] or "", r["after"] or "", known)) for r in rows]
    known = spark.createDataFrame(rows, "label double, _features array<double>").select("label", array_to_vector("_features").alias("features"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, subsamplingRate=0.7).fit(known.coalesce(1))


def scanned(docs: DataFrame, model: RandomForestClassificationModel, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every candidate of every whole text with the forest's chance that it is a secret, and is_secret from THRESHOLD on.

    A document without candidates has no row; one that repeats has its findings repeated; an empty table gives no rows. Other columns are
    never read. The forest and the dictionary are of fixed size and no shuffle is needed.
    """
    found = candidates(docs, id_col, text_col, words).withColumn("features", array_to_vector("_features"))
    scored = model.transform(found).withColumn("chance", vector_to_array("probability")[1])
    return scored.select("doc_id", "begin", "value", "before", "after", "chance", (F.col("chance") >= THRESHOLD).alias("is_secret"))

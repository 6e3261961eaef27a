"""Secrets in texts: patterns find candidates, a random forest removes false positives.

Candidates are values assigned to a name that speaks of a secret, passwords in URLs, strings
with the prefix of a known credential, private key blocks, and long mixed strings. The forest judges each by its
length, character transitions, dictionary coverage, path, and neighbouring words. It is
trained on ``labelled_findings``, a bounded set of labelled findings made here from a rule
and a seed (``FINDINGS``); its few thousand nodes travel with the tasks.

Defined cases: null and empty texts have no findings; texts are scanned whole, without
overlaps, the earlier and then the longer candidate first. A null path is an empty one.
Repeated rows have findings each, null ids stay null. An empty table gives an empty result.
``scan`` reads only the id, the text and the path; ``redact`` keeps all columns.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled findings made for training, their seed, and the forest's size.
FINDINGS, SEED, TREES, DEPTH = 4_000, 17, 40, 9
#: Characters before and after a candidate that its neighbouring words come from.
NEAR = 48
MARK = "[SECRET]"

# Names of secrets, known credential forms, and words near false positives.
_NAME = r"(?:key|token|secret|passw(?:or)?d|passphrase|pass(?![a-z])|pwd|credential|auth|signature)"
DETECTORS = (
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
    ("cloud_key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("code_host", r"\bgh[pousr]_[A-Za-z0-9]{36}\b"),
    ("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    ("service_key", r"\b(?:sk|pk|rk)[-_](?:live[-_]|test[-_])?[A-Za-z0-9]{16,}"),
    ("map_key", r"\bAIza[0-9A-Za-z_-]{35}"),
    ("web_token", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("url_password", r"://[^\s/@:]*:(?P<value>[^\s/@]+)@"),
    ("assigned", r"(?::=|=>|[:=])\s*[\"']?(?P<value>[^\s\"',;]{8,})"),
    ("mixed", r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/_-]*\d)(?=[A-Za-z0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}"),
)
#: Strings of which a text must hold one before a detector looks at it.
NEEDLES = {
    "private_key": ("-----BEGIN",),
    "cloud_key": ("AKIA", "ASIA"),
    "code_host": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "chat": ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"),
    "service_key": ("sk-", "sk_", "pk-", "pk_", "rk-", "rk_"),
    "map_key": ("AIza",),
    "web_token": ("eyJ",),
    "url_password": ("://",),
}
NAMED = re.compile(_NAME, re.IGNORECASE)
HARMLESS = re.compile(
    r"commit|sha\d*|md5|hash|checksum|digest|uuid|guid|version|revision|etag|build|image|base64|href|integrity",
    re.IGNORECASE,
)
PLACEHOLDER = re.compile(
    r"example|sample|dummy|changeme|your|placeholder|test|xxxx|\*\*\*|1234567|abcdef|<|\$\{|%", re.IGNORECASE
)
TRY_PATH = re.compile(r"test|example|sample|mock|fixture|doc|readme", re.IGNORECASE)
DICTIONARY = frozenset(
    "access account action active address admin after article auth author base before block body branch "
    "build button call change channel check class client code color column comment common config connect "
    "content count create current data date default delete detail device direct display document domain "
    "download email enable error event example fail feature field file filter final first folder form "
    "format function general get group handle head header host image index info init input insert internal "
    "invalid item key label last level library line link list load local location login main manager map "
    "master max media member memory message method mode model module name network node number object open "
    "option order output page param parent pass password path payment phone place point port position "
    "post prefix print private process product profile project property public query queue read record "
    "release remote remove report request reset resource response result return role root route rule "
    "sample save schema score screen search secret section select send server service session set setting "
    "simple size sort source start state static status step store stream string style system table target "
    "task template test text time title token tool total trace track type update upload user value "
    "version video view web width window word work write your".split()
)

_ALL = [(name, re.compile(pattern)) for name, pattern in DETECTORS]
_SIGN, _DIGIT = re.compile(r"[:=]"), re.compile(r"[0-9]")
_LONG = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_WORD = re.compile(r"[A-Za-z]+")
_CHUNKS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

FEATURES = (
    "length digits upper lower symbols hex distinct entropy switches letter_runs vowels coverage "
    "digit_only named_before harmless_near placeholder try_path assigned known mixed quoted words_before "
    "dashes"
).split()


def _name_before(text: str, sign: int) -> tuple[int, int]:
    """Where the name left of an assignment sign is, however long and far; empty if there is none."""
    high = sign
    while high and text[high - 1].isspace():
        high -= 1
    if high and text[high - 1] in "\"'":
        high -= 1
    low = high
    while low and (text[low - 1].isalnum() or text[low - 1] == "_"):
        low -= 1
    return low, high


def _matches(name: str, pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """All matches of a detector, looked for only where one can be."""
    if name == "assigned":
        for sign in _SIGN.finditer(text):
            low, high = _name_before(text, sign.start())
            if low < high and NAMED.search(text, low, high):
                match = pattern.match(text, sign.start())
                if match:
                    yield match
    elif name == "mixed":
        if _DIGIT.search(text):
            for run in _LONG.finditer(text):
                yield from pattern.finditer(text, run.start(), run.end() + 2)
    elif any(needle in text for needle in NEEDLES[name]):
        yield from pattern.finditer(text)


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, detector) in order, without overlaps."""
    found = set()
    for rank, (name, pattern) in enumerate(_ALL):
        group = "value" if "value" in pattern.groupindex else 0
        for match in _matches(name, pattern, text):
            found.add((match.start(group), -match.end(group), rank, name))
    out, reached = [], 0
    for start, end, _, name in sorted(found):
        if start >= reached:
            out.append((start, -end, name))
            reached = -end
    return out


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def describe(text: str, start: int, end: int, detector: str, path: str) -> list[float]:
    """The features of one candidate, in the order of ``FEATURES``."""
    value = text[start:end]
    size = len(value)
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    kinds = [_kind(c) for c in value]
    counts = Counter(value)
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    letters = sum(k in (1, 2) for k in kinds)
    runs = [len(w) for w in _WORD.findall(value)]
    covered = sum(len(w) for w in _CHUNKS.findall(value) if w.lower() in DICTIONARY)
    return [
        float(size),
        kinds.count(0) / size,
        kinds.count(2) / size,
        kinds.count(1) / size,
        kinds.count(3) / size,
        float(all(c in "0123456789abcdefABCDEF" for c in value)),
        len(counts) / size,
        entropy,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / size,
        max(runs, default=0) / size,
        sum(c in "aeiouAEIOU" for c in value) / max(1, letters),
        covered / size,
        float(kinds.count(0) == size),
        float(NAMED.search(before) is not None),
        float(HARMLESS.search(before) is not None or HARMLESS.search(after[:12]) is not None),
        float(PLACEHOLDER.search(value) is not None),
        float(TRY_PATH.search(path) is not None),
        float(detector == "assigned"),
        float(detector not in ("assigned", "mixed")),
        float(detector == "mixed"),
        float(before[-1:] in ("'", '"')),
        float(len(_WORD.findall(before))),
        float(value.count("-") + value.count("/")),
    ]


def labelled_findings(count: int = FINDINGS, seed: int = SEED) -> list[tuple[str, str, int]]:
    """(path, text, label): a text with one finding to be judged, secret (1) or not (0)."""
    draw = random.Random(seed)
    words = sorted(DICTIONARY)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed = lower + lower.upper() + digits

    def chars(alphabet: str, low: int, high: int) -> str:
        return "".join(draw.choice(alphabet) for _ in range(draw.randint(low, high)))

    def prose(low: int, high: int) -> str:
        made = [draw.choice([draw.choice(words), chars(lower, 2, 10)]) for _ in range(draw.randint(low, high))]
        return " ".join(made)

    def name() -> str:
        core = draw.choice(["token", "api_key", "secret", "password", "access_key", "auth", "pwd", "credential", "key", "private_key", "encryption_key", "AccountKey", "signature", "passphrase"])
        return draw.choice([core, core.upper(), f"{draw.choice(words)}_{core}"])

    def other() -> str:
        return draw.choice(["", "export ", "?", "&"]) + draw.choice([str.upper, str.lower])(f"{draw.choice(words)}_{chars(lower, 2, 6)}")

    def url(value: str) -> str:
        return f"{draw.choice(['postgres', 'https', 'amqp', 'redis', 'mysql'])}://{draw.choice(words)}:{value}@{draw.choice(words)}.{draw.choice(['com', 'local:5432'])}/{draw.choice(words)}"

    def given(value: str, key: str) -> str:
        mark = draw.choice(["=", " = ", ": ", ":", "=>"])
        quote = draw.choice(['"', "'", ""])
        return f"{key}{mark}{quote}{value}{quote}"

    def secret() -> str:
        kind = draw.random()
        if kind < 0.4:
            value = draw.choice([chars("0123456789abcdef", 32, 64), chars("0123456789ABCDEF", 32, 64), chars(mixed, 16, 60), chars(mixed + "+/_-", 20, 80)])
            return given(value, name())
        if kind < 0.5:
            return given(chars(mixed + "!@#$^&*", 10, 24), draw.choice(["password", "passwd", "PASSWORD", "db_password"]))
        if kind < 0.6:
            return f"{other()}={draw.choice([chars(mixed, 28, 64), chars(mixed + '+/', 40, 88)])}"
        if kind < 0.7:
            return url(draw.choice([chars(mixed, 6, 24), chars(mixed + "!#$^&*", 8, 20), draw.choice(words) + chars(digits, 2, 4)]))
        return draw.choice([
            "AKIA" + chars(lower.upper() + digits, 16, 16), "ghp_" + chars(mixed, 36, 36), "sk-" + chars(mixed, 24, 48),
            "xoxb-" + chars(digits, 10, 12) + "-" + chars(mixed, 24, 24), "AIza" + chars(mixed + "_-", 35, 35), "sk_live_" + chars(mixed, 24, 24),
            "eyJ" + chars(mixed, 15, 40) + "." + chars(mixed, 20, 60) + "." + chars(mixed, 20, 43),
        ])

    def harmless() -> str:
        kind = draw.randrange(11)
        dotted = draw.choice(["_", "-", ""]).join(draw.choice(words).capitalize() for _ in range(draw.randint(3, 7)))
        if kind == 0:
            return f"{draw.choice(['commit', 'sha256', 'md5', 'hash', 'checksum', 'revision', 'digest'])}{draw.choice([' ', ' ', '=', ': '])}{chars('0123456789abcdef', 32, 64)}"
        if kind == 1:
            return draw.choice(["uuid ", "uuid=", "guid: "]) + "-".join(chars("0123456789abcdef", n, n) for n in (8, 4, 4, 4, 12))
        if kind == 2:
            return dotted + str(draw.randint(1, 999))
        if kind == 3:
            return given(draw.choice(["your_token_here", "changeme123", "xxxxxxxxxxxxxxxx", "example-token-1234", "<your-api-key>", "${API_TOKEN}", "************", "placeholder_value"]), name())
        if kind == 4:
            return given(draw.choice([dotted, dotted.lower(), f"get_{dotted}()", f"os.environ[{dotted}]"]), name())
        if kind == 5:
            return "/".join([draw.choice(words), dotted, draw.choice(words), str(draw.randint(1, 10**6))])
        if kind == 6:
            return "image base64 " + chars(mixed + "+/", 60, 200)
        if kind == 7:
            return "version-" + "-".join([*(str(draw.randint(0, 99)) for _ in range(3)), dotted.lower(), chars(digits, 6, 10)])
        if kind == 8:
            return url(draw.choice(["<password>", "${PASSWORD}", "your_password", "xxxxxxxx", "%s", "example"]))
        if kind == 9:
            return f"{other()}={draw.choice([dotted, dotted.lower()])}{draw.randint(1, 999)}"
        return given(draw.choice(words) + draw.choice(words) + draw.choice(words), name())

    out = []
    for _ in range(count):
        label = int(draw.random() < 0.5)
        path = draw.choice(["src/app.py", "config/prod.env", "web", "src3", "", "tests/test_auth.py", "docs/example.md"])
        core = secret() if label else harmless()
        if label and TRY_PATH.search(path) and draw.random() < 0.5:
            path = "src/main"
        out.append((path, f"{prose(0, 9)} {core} {prose(0, 9)}".strip(), label))
    return out


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: inner nodes have a feature, leaves (-1) the share of secrets."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def chance(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets over the trees; children of a node are left and left + 1."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for tree in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            while (inner := self.feature[tree][node] >= 0).any():
                chosen = self.feature[tree][node]
                right = x[rows, np.maximum(chosen, 0)] > self.threshold[tree][node]
                node = np.where(inner, self.left[tree][node] + right, node)
            total += self.value[tree][node]
        return total / len(self.feature)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest:
    """Bagged trees with Gini splits; every node looks at a random third of the features."""
    draw = np.random.default_rng(seed)
    size = 1 << (depth + 1)
    feature, threshold = np.full((trees, size), -1), np.zeros((trees, size))
    left, value = np.zeros((trees, size), dtype=np.int64), np.zeros((trees, size))
    looked_at = max(1, x.shape[1] // 3)
    for tree in range(trees):
        bag = draw.integers(0, len(x), len(x))
        used, work = 1, [(0, bag, 0)]
        while work:
            node, rows, level = work.pop()
            value[tree, node] = y[rows].mean()
            if level == depth or len(rows) < 4 or value[tree, node] in (0.0, 1.0):
                continue
            best = (np.inf, -1, 0.0)
            for f in draw.choice(x.shape[1], looked_at, replace=False):
                column = x[rows, f]
                for cut in np.unique(np.quantile(column, draw.random(8), method="lower")):
                    right = column > cut
                    n = right.sum()
                    if 0 < n < len(rows):
                        p, q = y[rows[right]].mean(), y[rows[~right]].mean()
                        impurity = n * p * (1 - p) + (len(rows) - n) * q * (1 - q)
                        if impurity < best[0]:
                            best = (impurity, f, cut)
            if best[1] < 0 or used + 2 > size:
                continue
            feature[tree, node], threshold[tree, node], left[tree, node] = best[1], best[2], used
            right = x[rows, best[1]] > best[2]
            work += [(used, rows[~right], level + 1), (used + 1, rows[right], level + 1)]
            used += 2
    return Forest(feature, threshold, left, value)


def table_of(findings: list[tuple[str, str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of every candidate in labelled texts."""
    x, y = [], []
    for path, text, label in findings:
        for start, end, detector in candidates(text):
            x.append(describe(text, start, end, detector, path))
            y.append(label)
    return np.array(x), np.array(y, dtype=float)


def trained(count: int = FINDINGS, seed: int = SEED) -> Forest:
    return grow(*table_of(labelled_findings(count, seed)))


def judged(text: str | None, path: str | None, forest: Forest) -> list[tuple[int, int, str, float]]:
    """(start, end, detector, chance) of every candidate of a text."""
    found = candidates(text or "")
    if not found:
        return []
    x = np.array([describe(text, *c, path or "") for c in found])
    return [(*c, float(p)) for c, p in zip(found, forest.chance(x), strict=True)]


def scan(
    docs: DataFrame,
    forest: Forest | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
) -> DataFrame:
    """Per candidate: doc_id, start and end (characters), detector, score, is_secret (0.5 on)."""
    sent = docs.sparkSession.sparkContext.broadcast(forest or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, body, where in zip(*batch.columns, strict=True):
                for finding in judged(body.as_py(), where.as_py(), sent.value):
                    rows.append((doc_id.as_py(), *finding, finding[-1] >= 0.5))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "start", "end", "detector", "score", "is_secret"],
            )

    return docs.select(
        F.col(id_column).cast("long"),
        F.col(text),
        (F.col(path).cast("string") if path else F.lit("")).alias("path"),
    ).mapInArrow(
        run, "doc_id long, start long, end long, detector string, score double, is_secret boolean"
    )


def redact(
    docs: DataFrame, forest: Forest | None = None, text: str = "text", path: str | None = "source"
) -> DataFrame:
    """All rows and columns, with every secret in the text replaced by ``MARK``."""
    sent = docs.sparkSession.sparkContext.broadcast(forest or trained())
    place = docs.columns.index(text)
    where = docs.columns.index(path) if path else None

    def cleaned(body: str | None, source: str | None) -> str | None:
        out, reached = [], 0
        for start, end, _, chance in judged(body, source, sent.value):
            if chance >= 0.5:
                out += [body[reached:start], MARK]
                reached = end
        return "".join([*out, body[reached:]]) if out else body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(place)
            paths = [None] * len(bodies) if where is None else batch.column(where).to_pylist()
            new = pa.array(
                [cleaned(b.as_py(), str(p or "")) for b, p in zip(bodies, paths, strict=True)],
                bodies.type,
            )
            columns = [new if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)

"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read tag by tag into leaf blocks: maximal runs of text without a block-level tag
between them, each with flags of all its ancestors (tag, role, class and id words) and
features of its text. A chain field with two labels, trained on labelled pages, scores each
block's features and each pair of neighbouring labels; Viterbi decoding picks the labels and
the kept blocks form the text.

The labelled pages are made by ``labelled_pages``: layouts of many kinds, filled with
made-up words, in which every block carries its label. Their number is a bounded, documented
parameter (``PAGES``); the field is trained on the driver and its few hundred weights travel
with the tasks.

Defined cases: a null or empty page has an empty text; so has one without main text. Broken
markup is read as far as it goes: an unclosed comment, script or style runs to the end. Pages
are read whole; nothing is cut. Repeated rows are extracted each, null ids and URLs stay null,
other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages the field is trained on, the seed of their making, and steps of training.
PAGES, SEED, STEPS = 400, 11, 250

# Element names of HTML by their role in the page.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html iframe legend li main "
    "menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul "
    "label head".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe select".split())
#: Raw elements that run to the page's end if they are not closed; others end at the next block.
ENDLESS = frozenset("script style".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words in class, id and role attributes, by the part of a page they name.
HINTS = {
    "content": "article content post entry story body text prose main paragraph",
    "advert": "ad ads advert advertisement banner promo sponsor sponsored teaser",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager tabs toc search",
    "top": "header masthead topbar top logo brand toolbar banner",
    "bottom": "footer foot copyright legal imprint contentinfo bottom colophon",
    "side": "sidebar side aside widget related recommended popular trending complementary rail more",
    "notice": "cookie cookies consent notice popup modal newsletter subscribe alert gdpr dialog overlay",
    "comment": "comment comments reply replies disqus discussion respond feedback",
    "share": "share social follow tags tag meta byline author date credit",
    "form": "form login signup field input",
}
_HINT_OF: dict[str, list[str]] = {}
for _part, _words in HINTS.items():
    for _word in _words.split():
        _HINT_OF.setdefault(_word, []).append(_part)

# Words typical of text around an article.
AROUND = frozenset(
    "cookie cookies subscribe newsletter login log sign register privacy terms copyright rights "
    "reserved share tweet menu home contact imprint impressum datenschutz advertisement anzeige "
    "publicité publicidad comments comment reply related read accept".split()
)

_TAGS = (
    "article main nav header footer aside form ul ol table section blockquote pre figure figcaption "
    "button label p h1 h2 h3 h4 h5 h6 div li td dd a"
).split()
_NAMES = [f"in {t}" for t in _TAGS] + [f"hint {h}" for h in HINTS]
_NUMBER = {name: i for i, name in enumerate(_NAMES)}
_TEXT = (
    ["always"]
    + [f"own {t}" for t in ("p", "heading", "li", "div", "td", "other")]
    + [f"words {b}" for b in range(7)]
    + [f"links {b}" for b in range(4)]
    + ["stop", "mark", "around", "copyright", "no letters", "first", "after heading"]
)
_BASE = len(_NAMES)
_TEXT_NUMBER = {name: _BASE + i for i, name in enumerate(_TEXT)}
FEATURES = _BASE + len(_TEXT)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    # A quoted value may hold < and >; a quote that is never closed so is a plain character.
    r"(?P<rest>(?:=\s*\"[^\"]*\"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|[^<>])*+)>|"
    r"<(?P<tag2>/?[a-zA-Z][^\s/<>]*)(?P<rest2>[^<>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"(class|id|role|data-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE
)
#: A slash that closes a drawing's element; one in an unquoted value belongs to the value.
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
#: The place before the next block element.
_NEXT_BLOCK = re.compile(rf"(?=</?(?:{'|'.join(sorted(BLOCKS - RAW - {'option'}))})[\s/>])", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """A leaf block; ``label`` is set only in labelled pages."""

    flags: int
    own: str
    label: str
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _flags(tag: str, rest: str) -> tuple[int, str]:
    """Ancestor flags an element gives to what it holds, and its label if it has one."""
    out, label = 0, ""
    if (number := _NUMBER.get(f"in {tag}")) is not None:
        out |= 1 << number
    if "=" in rest:
        for name, *values in _ATTRIBUTE.findall(rest):
            value = "".join(values)
            if name.lower() == "data-label":
                label = value
                continue
            for word in _WORD.findall(value.lower()):
                for part in _HINT_OF.get(word, ()):
                    out |= 1 << _NUMBER[f"hint {part}"]
    return out, label


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, without empty ones."""
    out: list[Block] = []
    stack: list[tuple[str, int, str]] = [("", 0, "")]
    open_tags: dict[str, int] = {}
    links = 0
    current: Block | None = None

    def pop() -> None:
        nonlocal links
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        links -= tag == "a"

    def add(piece: str) -> None:
        nonlocal current
        if current is None:
            if not piece.strip():
                return
            own = next((s[0] for s in reversed(stack) if s[0] in BLOCKS), "")
            current = Block(stack[-1][1], own, stack[-1][2])
            out.append(current)
        current.parts.append(piece)
        if links:
            current.linked += len(piece)

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None and found["tag2"] is None:
            continue
        if tag is None:
            end, tag, rest = found["tag2"].startswith("/"), found["tag2"].lstrip("/"), found["rest2"]
        else:
            end, rest = bool(found["end"]), found["rest"]
        tag = tag.lower()
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            current = None
        if end:
            if open_tags.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            if tag == "svg" and _SELF_CLOSED.search(rest):
                continue
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            if close is None and tag not in ENDLESS:
                close = _NEXT_BLOCK.search(page, at)
            at = close.end() if close else size
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS and open_tags.get("p"):
            while stack[-1][0] != "p":
                pop()
            pop()
        closes = CLOSES.get(tag)
        while closes and stack[-1][0] in closes:
            pop()
        flags, label = _flags(tag, rest)
        stack.append((tag, stack[-1][1] | flags, label or stack[-1][2]))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        links += tag == "a"
    kept = []
    for block in out:
        block.text = _SPACE.sub(" ", html.unescape("".join(block.parts))).strip()
        if block.text:
            kept.append(block)
    return kept


_WORD_BINS = (2, 5, 11, 26, 61, 151)


def features(page: list[Block]) -> list[list[int]]:
    """Numbers of the features each block has."""
    out = []
    before = ""
    numbers: dict[int, list[int]] = {}
    for i, block in enumerate(page):
        have = numbers.get(block.flags)
        if have is None:
            have = [n for n in range(_BASE) if block.flags >> n & 1]
            numbers[block.flags] = have
        text, own = block.text, block.own
        words = text.count(" ") + 1
        kind = "heading" if own in HEADINGS else own if own in ("p", "li", "div", "td") else "other"
        shown = ["always", f"own {kind}", f"words {bisect_right(_WORD_BINS, words)}"]
        density = block.linked / max(1, sum(map(len, block.parts)))
        shown.append(f"links {0 if density == 0 else 1 if density < 0.3 else 2 if density < 0.7 else 3}")
        if text[-1] in ".!?…。\"”":
            shown.append("stop")
        if any(c in text for c in "|·»›•"):
            shown.append("mark")
        if words <= 40 and any(w.strip(".,:!?").lower() in AROUND for w in text.split(" ")):
            shown.append("around")
        if "©" in text:
            shown.append("copyright")
        if not any(c.isalpha() for c in text):
            shown.append("no letters")
        if i == 0:
            shown.append("first")
        if before in HEADINGS:
            shown.append("after heading")
        before = own
        out.append(have + [_TEXT_NUMBER[s] for s in shown])
    return out


@dataclass(frozen=True)
class Field:
    """Weights: ``emit[f]`` of feature f for label 1 against 0, ``move[a, b]`` of neighbours."""

    emit: np.ndarray
    move: np.ndarray

    def decode(self, rows: list[list[int]]) -> list[int]:
        """Most likely labels (Viterbi)."""
        emit, ((m00, m01), (m10, m11)) = self.emit, self.move.tolist()
        zero = one = 0.0
        back = []
        for i, row in enumerate(rows):
            score = float(emit[row].sum())
            if i == 0:
                one = score
                continue
            from0 = zero + m00 >= one + m10
            from1 = zero + m01 >= one + m11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            zero, one = (
                zero + m00 if from0 else one + m10,
                (zero + m01 if from1 else one + m11) + score,
            )
        if not rows:
            return []
        label = int(one > zero)
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return labels[::-1]


def train(pages: list[tuple[list[list[int]], list[int]]], steps: int = STEPS) -> Field:
    """Maximise the regularised conditional likelihood of the labels by gradient steps.

    All pages move through the forward and backward recursions together, padded to the
    longest one.
    """
    pages = [p for p in pages if p[0]]
    longest = max(len(rows) for rows, _ in pages)
    x = np.zeros((len(pages), longest, FEATURES))
    y = np.zeros((len(pages), longest), dtype=int)
    on = np.zeros((len(pages), longest), dtype=bool)
    for p, (rows, labels) in enumerate(pages):
        for t, row in enumerate(rows):
            x[p, t, row] = 1
        y[p, : len(labels)] = labels
        on[p, : len(labels)] = True
    pairs = on[:, 1:]
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & pairs).sum()
    emit, move = np.zeros(FEATURES), np.zeros((2, 2))
    moments = [np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)]
    total = on.sum()
    for step in range(1, steps + 1):
        scores = np.zeros((len(pages), longest, 2))
        scores[:, :, 1] = np.where(on, x @ emit, 0)
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(
                forward[:, t - 1, 0, None] + move[0], forward[:, t - 1, 1, None] + move[1]
            )
            forward[:, t] = np.where(on[:, t, None], new + scores[:, t], forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = backward[:, t + 1] + scores[:, t + 1]
            new = np.logaddexp(ahead[:, 0, None] + move[:, 0], ahead[:, 1, None] + move[:, 1])
            backward[:, t] = np.where(on[:, t + 1, None], new, 0)
        norm = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        likely = np.exp(forward + backward - norm[:, None, None])[:, :, 1]
        wrong = np.where(on, y - likely, 0)
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                both = np.exp(
                    forward[:, :-1, a] + move[a, b] + scores[:, 1:, b] + backward[:, 1:, b] - norm[:, None]
                )
                expected[a, b] = both[pairs].sum()
        slope = np.concatenate([np.einsum("pt,ptf->f", wrong, x), (seen - expected).ravel()]) / total
        slope -= 1e-4 * np.concatenate([emit, move.ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        change = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        emit = emit + change[:FEATURES]
        move = move + change[FEATURES:].reshape(2, 2)
    return Field(emit, move)


def labelled_pages(count: int = PAGES, seed: int = SEED) -> list[str]:
    """Pages of many layouts in which ``data-label`` marks what is main text (1) or not (0)."""
    draw = random.Random(seed)
    syllables = "ka lo mi ter an de ru so vel ni pa es to re un gra fi mo sen ba".split()

    def word() -> str:
        return "".join(draw.choice(syllables) for _ in range(draw.randint(1, 4)))

    def some(low: int, high: int) -> str:
        return " ".join(word() for _ in range(draw.randint(low, high)))

    def sentences(low: int, high: int) -> str:
        return " ".join(some(2, 18).capitalize() + "." for _ in range(draw.randint(low, high)))

    def links(low: int, high: int, wrap: str = "li") -> str:
        return "".join(
            f'<{wrap}><a href="/{word()}">{some(1, 3)}</a></{wrap}>' for _ in range(draw.randint(low, high))
        )

    # Main text is not only smooth prose: cells, lists, codes and single words belong to it too.
    shapes = [lambda: sentences(1, 6)] * 6 + [
        lambda: some(1, 6).capitalize() + ".",
        lambda: some(1, 3),
        lambda: some(4, 60).replace(" ", " | "),
        lambda: some(3, 40).replace(" ", draw.choice(["*** ", "%%% ", "!! ", " · ", ", "])),
        lambda: some(1, 8).upper(),
        lambda: f"{some(1, 4)} = {draw.random()} {draw.randint(0, 10**9)}",
        lambda: str(draw.randint(0, 10**6)),
        lambda: f"{draw.choice(sorted(AROUND))} {some(1, 9)} {draw.choice(['©', '|', '', ''])}",
    ]

    def box(*parts: str) -> str:
        """A wrapper that names its part by class or id, or a bare one."""
        name = draw.choice(parts)
        mark = draw.choice([f'class="{name}"', f'id="{name}"', f'class="{word()} {name}-{word()}"'])
        return f"div {mark}"

    def off(tag: str, inner: str) -> str:
        return f'<{tag} data-label="0">{inner}</{tag.split(" ")[0]}>'

    def prose() -> str:
        out = []
        for _ in range(draw.randint(1, 9)):
            kind = draw.random()
            text = draw.choice(shapes)()
            if kind < 0.62:
                out.append(f"<p>{text}" + draw.choice(["</p>", "</p>", ""]))
            elif kind < 0.72:
                level = draw.choice(["h2", "h3"])
                out.append(f"<{level}>{some(1, 8)}</{level}>")
            elif kind < 0.78:
                out.append(f"<p><b>{some(1, 12)}.<br><p>{text}</p>")
            elif kind < 0.84:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li>{sentences(1, 1)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>")
            elif kind < 0.95:
                out.append(f'<p>{sentences(1, 2)} <a href="/{word()}">{some(1, 3)}</a> {sentences(1, 2)}</p>')
            else:
                out.append(f"<div>{text}</div>")
        return "".join(out)

    out = []
    for _ in range(count):
        top = []
        if draw.random() < 0.8:
            top.append(off(draw.choice(["nav", box("menu", "nav", "navbar"), 'div role="navigation"']), f"<ul>{links(2, 9)}</ul>"))
        if draw.random() < 0.6:
            top.append(off(draw.choice(["header", box("header", "masthead", "topbar")]), f"<h1>{some(1, 4)}</h1><p>{some(2, 8)}</p>"))
        if draw.random() < 0.3:
            top.append(off(box("breadcrumb", "pager"), links(1, 4, "span")))
        odd = []
        if draw.random() < 0.6:
            odd.append(off(draw.choice([box("ad", "advert", "banner", "promo", "sponsor"), 'div class="ad"']), draw.choice([sentences(1, 3), some(1, 8)])))
        if draw.random() < 0.4:
            odd.append(off(box("cookie", "consent", "notice", "newsletter", "popup"), f"<p>{sentences(1, 2)}</p><button>{some(1, 2)}</button>"))
        if draw.random() < 0.3:
            odd.append(off(draw.choice(["form", 'form class="login"']), f"<label>{some(1, 2)}</label><input><p>{some(2, 9)}</p><button>{word()}</button>"))
        if draw.random() < 0.4:
            odd.append(off(draw.choice(["aside", box("sidebar", "related", "widget")]), f"<h3>{some(1, 4)}</h3><ul>{links(2, 6)}</ul><p>{sentences(1, 2)}</p>"))
        title = f"<h1>{some(2, 12)}</h1>" if draw.random() < 0.85 else ""
        body = prose()
        inside = []
        if draw.random() < 0.3:
            inside.append(off(box("share", "social", "tags", "byline", "meta"), draw.choice([links(2, 4, "span"), some(2, 5)])))
        if draw.random() < 0.3:
            inside.append(off(box("ad", "promo", "related"), draw.choice([sentences(1, 2), f"<ul>{links(2, 4)}</ul>"])))
        comments = off(draw.choice([box("comments", "comment", "respond"), 'section id="comments"']), "".join(
            f'<div class="comment"><b>{word()}</b><p>{sentences(1, 3)}</p></div>' for _ in range(draw.randint(1, 4)))) if draw.random() < 0.4 else ""
        halves = body.split("<p>", 1) if inside and draw.random() < 0.5 else [body]
        body = (halves[0] + "".join(inside) + "<p>" + halves[1]) if len(halves) == 2 else body + "".join(inside)
        if comments and draw.random() < 0.4:
            body, comments = body + comments, ""
        holder = draw.choice(["article", "article", "article", "main", box("content", "post", "entry", "story"), 'section class="article-body"', "div", 'div role="main"'])
        text = f'<{holder} data-label="1">{title}{body}</{holder.split(" ")[0]}>'
        if draw.random() < 0.2:
            text = f'<main>{text}</main>'
        bottom = off(draw.choice(["footer", box("footer", "copyright", "legal")]), draw.choice([
            f"&copy; {word()}.example &middot; {sentences(1, 1)}", f"<p>&copy; {some(2, 6)}</p><ul>{links(1, 5)}</ul>", some(2, 6)]))
        draw.shuffle(odd)
        cut = draw.randint(0, len(odd))
        out.append(
            "<!DOCTYPE html><html><head><title>x</title></head><body>"
            + "".join(top + odd[:cut]) + text + comments + "".join(odd[cut:]) + bottom + "</body></html>"
        )
    return out


def trained(count: int = PAGES, seed: int = SEED) -> Field:
    """The field trained on the labelled pages."""
    data = []
    for page in labelled_pages(count, seed):
        found = blocks(page)
        data.append((features(found), [int(b.label == "1") for b in found]))
    return train(data)


def main_text(page: str | None, model: Field) -> str:
    found = blocks(page or "")
    labels = model.decode(features(found))
    return "\n\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(
    pages: DataFrame,
    model: Field | None = None,
    id_column: str = "page_id",
    url: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Per page: page_id, url, text (empty if none) and n_chars."""
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), model) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(html_column).alias("html"),
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")

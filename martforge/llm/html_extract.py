"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: the text between two block-level tags, with the tags, classes and ids of its
ancestors. Each block is main text or not; a linear-chain CRF scores ancestor and text features and the step from one
block to the next, and Viterbi decodes the best labelling of the whole page.

Training pages are labelled by their own markup: a page with an ``article`` (or ``main``) element says which blocks are
its text. To learn more than that one tag, each labelled page is also trained on with the element renamed to ``main`` or a
plain ``div``, and shortened, with labelled page furniture - the skeletons below - around and between its blocks and with
texts of a few words, so that neither length nor the neighbours decide alone. The sample of pages is
bounded by :class:`Limits`; decoding runs over all pages without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_REST = r"(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
_SKIPPED = "|".join(rf"<{n}{_REST}>.*?(?:</{n}\s*>|\Z)" for n in ("title", "script", "style", "noscript", "template"))
#: The head as far as it holds what may stand there: it ends at its end tag, the body or the first thing of the body.
HEAD = rf"<head{_REST}>(?:\s+|<!--.*?(?:-->|\Z)|{_SKIPPED}|<(?:meta|link|base){_REST}>)*+(?:</head\s*>)?"
#: One token: a comment, an element whose content is not text, the head, a tag, a declaration.
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe){_REST}>.*?(?:</\1\s*>|\Z)|{HEAD}"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S | re.I)
#: A tag that the end of the page cuts off.
CUT_TAG = re.compile(r"<[a-zA-Z/!][^<>]*\Z")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")
#: Elements that start and end a block, and those without an end tag. Fixed lists of HTML.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
option optgroup p pre search section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the left side ends where one of the right side begins inside the same container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",)}
CONTAINER = frozenset("ul ol menu dl table tbody thead tfoot select".split())

#: Labelled furniture for training; ``{}`` takes a text of another page. 0: not main text, 1: main text.
FURNITURE = [
    ('<header class="site-header"><div class="logo">{}</div></header>', 0), ('<nav class="menu"><ul><li><a href="#">{}</a></li></ul></nav>', 0),
    ('<div id="nav"><a href="/">{}</a></div>', 0), ('<div class="breadcrumb"><a href="/">{}</a></div>', 0),
    ('<aside class="sidebar"><h3>{}</h3><ul><li><a href="#">{}</a></li></ul></aside>', 0), ('<div class="sidebar"><p>{}</p></div>', 0),
    ('<div id="sidebar"><div class="widget"><p>{}</p></div></div>', 0), ('<div class="related"><h3>{}</h3><a href="#">{}</a></div>', 0),
    ('<div class="ad">{}</div>', 0), ('<div class="advert banner"><p>{}</p></div>', 0), ('<div class="promo sponsored">{}</div>', 0),
    ('<div class="cookie-notice"><p>{}</p><button>{}</button></div>', 0), ('<div id="cookie-banner" class="notice">{}</div>', 0),
    ('<div class="newsletter subscribe"><form><label>{}</label><input type="text"></form></div>', 0),
    ('<form action="/search"><label>{}</label><button>{}</button></form>', 0), ('<div class="share social"><a href="#">{}</a></div>', 0),
    ('<section class="comments"><h2>{}</h2><div class="comment"><p>{}</p></div></section>', 0), ('<div id="comments"><p>{}</p><p>{}</p></div>', 0),
    ('<ol class="comment-list"><li class="comment"><p>{}</p></li></ol>', 0), ('<footer><p>{}</p></footer>', 0),
    ('<div class="footer copyright">&copy; {}</div>', 0), ('<div id="footer"><p>{}</p></div>', 0),
    ("<p>{}</p>", 1), ("<h2>{}</h2><p>{}</p>", 1), ("<ul><li>{}</li><li>{}</li></ul>", 1), ("<blockquote><p>{}</p></blockquote>", 1),
    ("<table><tr><td>{}</td><td>{}</td></tr></table>", 1), ("<pre>{}</pre>", 1), ('<figure><figcaption>{}</figcaption></figure>', 1),
]

#: Elements, and words of classes and ids, that hold no main text. Fixed lists.
OFF_TAGS = ("nav", "aside", "form", "footer", "header")
OFF_WORDS = tuple("""ad ads advert advertisement banner breadcrumb comment comments consent cookie copyright discussion
disqus footer header login masthead menu nav navbar navigation newsletter notice popup promo recommended related replies
respond reviews share sidebar signup social sponsored subscribe widget""".split())
#: Words of classes that hold main text. Fixed list.
ON_WORDS = tuple("article body content entry main post story text".split())


def forms() -> list[tuple[str, int]]:
    """``FURNITURE``, and every tag and word of the lists by itself, so that each is learnt without the others."""
    bare = [(f"<{t}>{inner}</{t}>", 0) for t in OFF_TAGS for inner in ("{}", "<p>{}</p>", "<h3>{}</h3><p>{}</p>", '<ul><li><a href="#">{}</a></li></ul>')]
    bare += [(f'<{tag}="{w}">{inner}</{tag.split()[0]}>', 0) for w in OFF_WORDS
             for tag, inner in (("div class", "<p>{}</p>"), ("section id", "<h2>{}</h2><p>{}</p>"), ("div id", "{}"))]
    bare += [(f'<{tag}="{w}">{inner}</{tag.split()[0]}>', 1) for w in ON_WORDS
             for tag, inner in (("div class", "<p>{}</p><p>{}</p>"), ("section id", "<h2>{}</h2><p>{}</p>"))]
    return FURNITURE + bare + [("<section><h2>{}</h2><p>{}</p></section>", 1), ("<div><p>{}</p></div>", 1)]


@dataclass(frozen=True)
class Limits:
    """Bounds of the training sample and of the fit."""

    pages: int = 300
    max_chars: int = 20_000  # longer pages are not taken into the sample
    rounds: int = 150


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # ancestors: tag, class and id words
    linked: int  # characters inside links
    index: int


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks of a page in page order: references decoded, white space runs as one space, trimmed, none empty.

    The content of an svg is no text. One that is never closed ends with the element around it, or where a block begins.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked = 0
    svg = -1  # place of the open svg on the stack

    def close() -> None:
        nonlocal linked
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                out.append(Block(text, tuple(stack), min(linked, len(text)), len(out)))
            held.clear()
        linked = 0

    html = html or ""
    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at and svg < 0:
            held.append(html[at:m.start()])
            if any(tag == "a" for tag, _ in stack):
                linked += m.start() - at
        at = m.end()
        tag = (m.group(3) or m.group(6) or "").lower()
        if not tag:
            if svg < 0 and (m.group(1) and m.group(1).lower() != "noscript" or m.group()[:5].lower() == "<head"):
                close()
            continue
        if svg >= 0:
            if m.group(2) or m.group(5):
                open_at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)
                if open_at < 0 or open_at >= svg:  # of the drawing itself
                    if open_at >= 0:
                        del stack[open_at:]
                    svg = svg if len(stack) > svg else -1
                    continue
                svg = -1
            elif tag in BLOCK and tag != "title" and not any(t == "foreignobject" for t, _ in stack[svg:]):
                del stack[svg:]
                svg = -1
            else:
                if not (m.group(4) or m.group(7) or "").endswith("/") and tag not in VOID:
                    stack.append((tag, ()))
                continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCK:
            close()
        if m.group(2) or m.group(5):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in BLOCK:  # an open paragraph ends here, as does a list item or cell of the same list or row
            for k in range(len(stack) - 1, -1, -1):
                name = stack[k][0]
                if name == "p" or name in CLOSES.get(tag, ()):
                    del stack[k:]
                    break
                if name in CONTAINER or name in BLOCK and name not in CLOSES:
                    break
        rest = m.group(4) or m.group(7) or ""
        if tag not in VOID and not rest.endswith("/"):
            names = tuple(w for g in NAMES.findall(rest) for w in PART.findall("".join(g).lower())) if "=" in rest else ()
            stack.append((tag, names))
            if tag == "svg":
                svg = len(stack) - 1
    if svg < 0:
        held.append(CUT_TAG.sub("", html[at:]))
    close()
    return out


def features(page: list[Block]) -> list[list[str]]:
    """Feature names of every block of a page."""
    out = []
    for block in page:
        own = {"bias"}
        for tag, names in block.path:
            own.add(f"a:{tag}")
            own.update(f"c:{n}" for n in names)
        if block.path:
            own.add(f"t:{block.path[-1][0]}")
        text = block.text
        own.add(f"n:{min(len(text).bit_length(), 10)}")
        own.add(f"l:{4 * block.linked // max(1, len(text))}")
        own.add("end" if text[-1] in ".!?:;\"'»”" else "open")
        if text[0] == "©" or "©" in text[:40]:
            own.add("copyright")
        out.append(sorted(own))
    return out


@dataclass
class Model:
    weights: dict[str, tuple[float, float]]
    step: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, page: list[Block]) -> list[int]:
        """Viterbi: the labels with the highest total score; ties go to 0."""
        none = (0.0, 0.0)
        get = self.weights.get
        (s00, s01), (s10, s11) = self.step
        best, back = (0.0, 0.0), []
        for i, names in enumerate(features(page)):
            e0 = e1 = 0.0
            for n in names:
                a, b = get(n, none)
                e0 += a
                e1 += b
            if i:
                from0, from1 = (best[0] + s00, best[1] + s10), (best[0] + s01, best[1] + s11)
                back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
                best = (max(from0) + e0, max(from1) + e1)
            else:
                best = (e0, e1)
        labels = [int(best[1] > best[0])] if page else []
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]

    def extract(self, html: str | None) -> str:
        page = blocks(html)
        return "\n\n".join(b.text for b, y in zip(page, self.decode(page)) if y)


def labelled(html: str) -> list[tuple[Block, int]]:
    """Blocks and labels of a page that marks its text with article or main; empty if it does not."""
    page = blocks(html)
    marks = ("article", "main")
    if not any(tag in marks for b in page for tag, _ in b.path):
        return []
    furniture, words = {*OFF_TAGS, "button"}, set(OFF_WORDS)
    out = []
    for b in page:
        tags = [tag for tag, _ in b.path]
        inside = next((i for i, tag in enumerate(tags) if tag in marks), None)
        names = {n for _, own in b.path[(inside or 0) + 1:] for n in own}
        bad = furniture & set(tags[inside:]) if inside is not None else ()
        out.append((b, int(inside is not None and not bad and not names & words)))
    return out


def _variants(pages: list[str]) -> list[list[tuple[list[str], int]]]:
    """Training sequences (features, label): every labelled page plain, unmarked, and amid furniture."""
    out = []
    texts = [b.text for html in pages for b in blocks(html)] or ["text"]
    place = 0

    def few(text: str, n: int) -> str:
        return " ".join(text.split()[:n]) + "."

    def cut(rows: list[tuple[Block, int]], n: int) -> list[tuple[Block, int]]:
        """Two blocks of the main text from each end, of a few words every other time."""
        own = [i for i, (_, y) in enumerate(rows) if y]
        gone = set(own[2:-2])
        return [(Block(few(b.text, 2 + n % 7), b.path, 0, 0) if y and n % 2 else b, y) for i, (b, y) in enumerate(rows) if i not in gone]

    def filled(form: str) -> list[Block]:
        nonlocal place
        while "{}" in form:
            text = texts[place % len(texts)]
            text = text if place % 2 else few(text, 2 + place % 5)
            form = form.replace("{}", text.replace("&", "&amp;").replace("<", "&lt;"), 1)
            place += 7
        return blocks(form)

    known = forms()
    bodies = [labelled(html) for html in pages]
    turn = 0
    for body in [b for b in bodies if b] or [[]]:
        rows = [(b, y) for b, y in body]
        out.append(rows)
        plain, main = ([(Block(b.text, tuple((name if t in ("article", "main") else t, names) for t, names in b.path), b.linked, 0), y)
                        for b, y in rows] for name in ("div", "main"))
        out += [plain, cut(rows, turn)]
        for base in (rows, plain, main, rows):
            mixed = cut(base, turn)
            kin = next((b.path[:-1] for b, y in base if y), ())
            for _ in range(6):
                turn += 1
                form, y = known[turn % len(known)]
                first = next((i for i, (_, label) in enumerate(mixed) if label), len(mixed))
                last = max((i + 1 for i, (_, label) in enumerate(mixed) if label), default=len(mixed))
                # by turns in front of the text, amid its blocks, behind it, amid its blocks
                side = turn // len(known) % 4
                amid = y or side % 2
                spot = min(last, first + 1 + turn % max(1, last - first - 1)) if amid else (first, last)[side // 2]
                inner = [(Block(b.text, (*(kin if amid or turn // len(known) // 4 % 2 else kin[:2]), *b.path), b.linked, 0), y) for b in filled(form)]
                mixed[spot:spot] = inner
            out.append(mixed)
    for form, y in known:
        out.append([(b, y) for b in filled(form)])
    return [list(zip(features([b for b, _ in rows]), [y for _, y in rows])) for rows in out if rows]


def train(pages: list[str], limits: Limits = Limits()) -> Model:
    """Fits the CRF by gradient ascent on the conditional likelihood. Pages without labels only lend their texts."""
    data = _variants(pages)
    names = sorted({f for rows in data for fs, _ in rows for f in fs})
    at = {f: i for i, f in enumerate(names)}
    long = max(len(rows) for rows in data)
    y = np.full((len(data), long), -1)
    seq, pos, feat = [], [], []
    for i, rows in enumerate(data):
        for j, (fs, label) in enumerate(rows):
            y[i, j] = label
            for f in fs:
                seq.append(i)
                pos.append(j)
                feat.append(at[f])
    seq, pos, feat = np.array(seq), np.array(pos), np.array(feat)
    held = y >= 0
    gold = np.stack([y == 0, y == 1], axis=2).astype(float)
    pairs = np.einsum("ija,ijb->ab", gold[:, :-1], gold[:, 1:])
    w, step = np.zeros((len(names), 2)), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(step), np.zeros_like(step)]
    total = held.sum()
    for turn in range(1, limits.rounds + 1):
        e = np.zeros((len(data), long, 2))
        np.add.at(e, (seq, pos), w[feat])
        ahead = np.zeros_like(e)
        behind = np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for j in range(1, long):
            ahead[:, j] = np.where(held[:, j, None], np.logaddexp(ahead[:, j - 1, 0, None] + step[0], ahead[:, j - 1, 1, None] + step[1]) + e[:, j],
                                   ahead[:, j - 1])
        for j in range(long - 2, -1, -1):
            reach = behind[:, j + 1] + e[:, j + 1]
            back = np.logaddexp(reach[:, 0, None] + step[:, 0], reach[:, 1, None] + step[:, 1])
            behind[:, j] = np.where(held[:, j + 1, None], back, behind[:, j + 1])
        norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        p = np.exp(ahead + behind - norm[:, None, None]) * held[:, :, None]
        joint = np.zeros((2, 2))
        for j in range(1, long):
            part = ahead[:, j - 1, :, None] + step + (e[:, j] + behind[:, j])[:, None, :] - norm[:, None, None]
            joint += (np.exp(np.minimum(part, 0)) * held[:, j, None, None]).sum(axis=0)
        gw = np.zeros_like(w)
        np.add.at(gw, feat, (gold - p)[seq, pos])
        gw, gs = gw / total - 1e-5 * w, (pairs - joint) / total
        for x, g, m, v in ((w, gw, moments[0], moments[1]), (step, gs, moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += 0.1 * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
    return Model({f: (float(w[i, 0]), float(w[i, 1])) for f, i in at.items()}, tuple(tuple(map(float, r)) for r in step))


def sample(pages: DataFrame, limits: Limits = Limits(), id_col: str = "page_id", html_col: str = "html") -> list[str]:
    """The training pages: those with the smallest id hashes among the ones that fit the limits."""
    fit = pages.where(F.length(html_col) <= limits.max_chars)
    ids = fit.select(id_col, F.xxhash64(id_col).alias("h")).where(F.col(id_col).isNotNull()).distinct().orderBy("h", id_col).limit(limits.pages)
    rows = fit.join(F.broadcast(ids), id_col).select(id_col, html_col).collect()  # bounded by limits
    return [r[1] for r in sorted(rows, key=lambda r: (r[0], r[1]))]


def extract(pages: DataFrame, model: Model, html_col: str = "html", out: str = "text") -> DataFrame:
    """Adds ``out`` (main text, empty if none) and n_chars (code points) to every page; no shuffle.

    Blocks keep all of their text and are joined in page order by two line feeds. Null and empty pages give an empty
    text. Columns of these names are replaced, all others pass; repeated rows each come back.
    """
    kept = [c for c in pages.columns if c not in (out, "n_chars")]
    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField(out, T.StringType()), T.StructField("n_chars", T.LongType())])
    shared = pages.sparkSession.sparkContext.broadcast(model)  # features of at most limits.pages pages

    def run(batches):
        read = shared.value.extract
        for batch in batches:
            texts = [read(h) for h in batch.column(batch.schema.get_field_index(html_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(texts, type=pa.string()),
                 pa.array([len(t) for t in texts], type=pa.int64())], names=[*kept, out, "n_chars"])

    return pages.mapInArrow(run, schema)

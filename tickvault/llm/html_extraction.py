"""Main text of web pages by union-free regular-expression inference per host.

A page becomes a stream of text slots, each named by the path of block elements around it
(with classes, ids and roles).  Adjacent repeats fold into a group ``(...)+``.  The folded
streams of a host are aligned one after another into one expression without alternation:
a slot that a page lacks becomes optional, a group that repeats on one page and stands
alone on another becomes repeated, and a text that differs makes its item a text slot; the
texts that every page has in an item are template texts.  Pages alike in every text outside
of menus, adverts and the like count once, so that copies of an article don't make its text
a template.  Only hashes of texts are kept for this.  Equal streams are summed map-side
first; a host's partial expressions are merged in groups of at most ``MERGED`` at a time,
again and again, so a host with a third of all pages costs no single task its pages.

A page is read by matching its folded stream against its host's expression, in order: what
stands in text slots is content, template texts are not, a heading that the template repeats
over content excepted.  Slots of a menu, header, footer, side bar, notice, advert, form or
comment are no content wherever they stand.  Among what is left, the text inside ``article``
or ``main`` elements goes before the text of elements named like one, and that before the
rest, as long as the preferred elements hold the larger part of such pages' text on the host.
Wrappers are broadcast while they fit ``max_wrapper_mb``, else pages are joined with them by
host.

Defined cases: null or empty html has no text (empty string, 0 characters); a null url or
one without a host belongs to the host ''; a host without unlike pages has no template;
broken nesting closes at the nearest open element; repeated rows each get a row; other
columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import difflib
import functools
import hashlib
import html as entities
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import map_batches, stage, use_small_batches

MERGED = 256         # partial expressions that one task aligns
#: Unlike pages that must share a text for it to be template, by rank of its slot.
SUPPORT = {0: 3, 1: 3, 2: 5}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 dt th caption legend summary".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open paragraph.
BLOCK = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table tbody td th tr ul".split())
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
              "th": ("td", "th"), "option": ("option",)}
JUNK_TAGS = frozenset("head title nav footer aside form button select option input textarea dialog menu".split())
#: Words of a class, id or role that mark an element as something else than the article.
JUNK_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe signup login nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside widget widgets related recommended share sharing social toolbar pagination pager comment "
    "teaser teasers comments commentlist disqus respond reply replies footer copyright disclaimer complementary contentinfo search".split())
HEAD_WORDS = frozenset("header masthead topbar".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article main content post entry story".split())
#: Words by which a class tells of a state or layout of the page, not what the element is: anywhere in
#: it (has-sidebar, content-with-sidebar), or as its last one (comments-open).
STATE_WORDS = frozenset("has no with without".split())
STATE_ENDS = frozenset("open closed enabled disabled".split())
#: First words of a class that tells of a post's topic, beside a class that names the post.
TOPIC_WORDS = frozenset("category tag type format status".split())
#: Elements whose class says how the page looks; it doesn't make them a menu or an advert.
PAGE_TAGS = frozenset(("html", "body", "main", "article"))
WORDS = re.compile(r"[a-z]+")


def names_of(marks) -> list[str]:
    """Classes, ids and roles, each as its words joined by hyphens, so that numbers don't tell elements apart."""
    return sorted({"-".join(WORDS.findall(name)) for a in marks for name in "".join(a[1:]).lower().split()} - {""})


def marked(names: list[str], words: frozenset) -> bool:
    """Does one of an element's classes, ids and roles say that it is one of the words?"""
    for name in names:
        own = name.split("-")
        if words.isdisjoint(own) or own[-1] in STATE_ENDS or not STATE_WORDS.isdisjoint(own):
            continue
        if own[0] in TOPIC_WORDS and not MAIN_WORDS.isdisjoint(names):
            continue
        return True
    return False


def slots(page: str) -> list[tuple[str, str]]:
    """(path, text) of every block with text, in page order."""
    stack: list[tuple[str, str]] = []
    out: list[tuple[str, str]] = []
    held: list[str] = []

    def flush():
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((">".join(label for _, label in stack), text))

    def close(tags, until=()):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                flush()
                del stack[k:]
                return
            if stack[k][0] in until:
                return

    for m in TOKEN.finditer(page):
        tag = m[3]
        if tag is None:
            if m[1] is None and not m[0].startswith(("<!", "<?")):
                held.append(m[0])
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        marks = ATTRIBUTE.findall(m[4]) if m[4] else ()
        if tag in INLINE and not any(k == tag and "." in label for k, label in stack[-1:]):
            if not marked(names_of(marks), JUNK_WORDS):
                continue
        if m[2]:
            close((tag,))
            continue
        if tag in BLOCK or tag == "body":
            close(("head",))
            close(("p",), ("article", "section", "div", "td", "li", "body"))
        if tag in SAME_LEVEL:
            close(SAME_LEVEL[tag], ("ul", "ol", "dl", "table", "select", "menu"))
        flush()
        if tag not in VOID and not m[4].rstrip().endswith("/"):
            stack.append((tag, tag + "".join(f".{name}" for name in names_of(marks))))
    flush()
    return out


def fold(stream: list[str]) -> list[tuple[str, ...]]:
    """Adjacent repeats of up to eight slots become one group; a group is a tuple of paths."""
    code: dict[str, str] = {}
    text = "".join(code.setdefault(x, chr(0x4E00 + len(code))) for x in stream)
    back = {v: k for k, v in code.items()}
    out, at = [], 0
    for m in re.finditer(r"(.{1,8}?)\1+", text):
        out += [(back[c],) for c in text[at:m.start()]]
        out.append(tuple(back[c] for c in m[1]))
        at = m.end()
    return out + [(back[c],) for c in text[at:]]


def mark(text: str) -> str:
    """What stands for a text in an expression: itself if short, else 72 bits of its hash."""
    return text if len(text) <= 12 else "=" + base64.b64encode(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=9).digest()).decode()


def content(page: str) -> tuple[list[list], list[int]]:
    """The folded stream of what may be main text, with marks for texts; and the characters by rank."""
    found = [(p, t) for p, t in slots(page) if rank(p) >= 0]
    size = [0, 0, 0]
    for p, t in found:
        size[rank(p)] += len(t)
    return [[g, list(map(mark, texts))] for g, texts in summary(found)], size


def summary(page: str | list[tuple[str, str]]) -> list[list]:
    """The folded stream of one page or its slots: [group, text] with the text under a group as a whole."""
    found = slots(page) if isinstance(page, str) else page
    out, at = [], 0
    for group in fold([p for p, _ in found]):
        end = at + len(group)
        while len(group) <= len(found) - end and tuple(p for p, _ in found[end:end + len(group)]) == group:
            end += len(group)
        out.append([list(group), [t for _, t in found[at:end]]])
        at = end
    return out


def common(one: list[str], other: list[str]) -> list[str]:
    """Texts of the first that the second has too."""
    has = set(other)
    return [t for t in one if t in has]


def unite(x: list, y: list) -> list:
    """Two items of the same group: [group, common texts, optional, unlike pages, do texts differ]."""
    return [x[0], x[1] if x[1] == y[1] else common(x[1], y[1]), x[2] or y[2], x[3] + y[3], x[4] or y[4] or x[1] != y[1]]


def align(one: list[list], other: list[list]) -> list[list]:
    """Merge two expressions: what only one of them has becomes optional."""
    a, b = ([tuple(x[0]) for x in side] for side in (one, other))
    out: list[list] = []
    for kind, a0, a1, b0, b1 in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind == "equal":
            out += map(unite, one[a0:a1], other[b0:b1])
        else:
            out += [[g, t, True, n, d] for g, t, _, n, d in one[a0:a1] + other[b0:b1]]
    return out


def expression(items: list[list]) -> str:
    """The inferred expression, for people to read."""
    return " ".join("(" + " ".join(g) + ("" if varies else " = template") + ")" + "+" * varies + "?" * bool(o) for g, _, o, _, varies in items)


@functools.lru_cache(1 << 16)
def rank(path: str) -> int:
    """2 inside an article, 1 inside what is named like one, 0 elsewhere, -1 for what is no main text."""
    level = 0
    for element in path.split(">"):
        tag, *names = element.split(".")
        if tag in JUNK_TAGS or (level < 2 and tag == "header"):
            return -1
        if tag not in PAGE_TAGS and (marked(names, JUNK_WORDS) or (level < 2 and marked(names, HEAD_WORDS))):
            return -1
        if tag in MAIN_TAGS:
            level = 2
        elif MAIN_WORDS & {w for n in names for w in n.split("-")}:
            level = max(level, 1)
    return level


def wrapper(items: list[list], pages: int, sizes: list[int]) -> dict:
    """The expression as pages are matched with it: groups and the template texts of each; and up
    to which rank preferred elements are trusted.  ``pages`` counts unlike ones; ``sizes`` are the
    host's characters: in and beside articles, in and beside elements named so."""
    varied = any(varies for *_, varies in items)

    def template(group, texts, n):
        level = max(rank(p) for p in group)
        enough = n >= SUPPORT[level] and (n >= pages / 4 if level < 2 else n >= 0.8 * pages)
        return sorted(set(texts)) if varied and enough else []

    trusted = [r for r, (own, rest) in ((2, sizes[:2]), (1, sizes[2:])) if 2 * own >= rest]
    return {"items": [[g, template(g, t, n)] for g, t, _, n, _ in items], "trusted": trusted, "expression": expression(items)}


def _parent(path: str) -> str:
    return path.rpartition(">")[0]


def main_text(page: str, made: dict) -> str:
    """The content of a page by its host's wrapper."""
    found = [(p, t) for p, t in slots(page) if rank(p) >= 0]
    places: dict[tuple, list[int]] = made["places"]
    kept, at = [], 0        # (is template, path, text); the place reached in the expression
    for group, texts in summary(found):
        here = places.get(tuple(group), ())
        k = bisect.bisect_left(here, at)
        known = frozenset()
        if k < len(here):
            at, known = here[k] + 1, made["texts"][here[k]]
        elif here:          # out of order: the item is known all the same
            known = made["texts"][here[-1]]
        kept += [(mark(t) in known, group[i % len(group)], t) for i, t in enumerate(texts)]
    out = []
    for k, (template, path, text) in enumerate(kept):
        heads = template and path.rpartition(">")[2].partition(".")[0] in HEADINGS
        if heads and k + 1 < len(kept) and not kept[k + 1][0] and _parent(kept[k + 1][1]).startswith(_parent(path)):
            template = False
        if not template:
            out.append((rank(path), text))
    best = max((r for r, _ in out if r in made["trusted"]), default=0)
    return "\n".join(t for r, t in out if r >= best)


def read_wrapper(text: str) -> dict:
    made = json.loads(text)
    places: dict[tuple, list[int]] = {}
    for k, (group, _) in enumerate(made["items"]):
        places.setdefault(tuple(group), []).append(k)
    return {"places": places, "texts": [frozenset(t) for _, t in made["items"]], "trusted": frozenset(made["trusted"])}


def host_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://([^/:?#]*)", 1), F.lit(""))


def _merge_all(rows: list[list[list]]) -> list[list]:
    out = rows[0]
    for other in rows[1:]:
        out = align(out, other)
    return out


PARTIAL = "host string, pages long, unlike long, sizes array<long>, items string"


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, pages, wrapper (JSON) of every host."""
    use_small_batches(pages.sparkSession)

    def summarise(cols):
        found: dict[tuple, list] = {}
        for host, page in zip(cols["host"], cols["html"]):
            items, (c0, c1, c2) = content((page or b"").decode("utf-8", "replace"))
            own = found.setdefault((host.decode(), json.dumps(items)), [0, [0, 0, 0, 0]])
            own[0] += 1
            beside = [c2, c0 + c1, 0, 0] if c2 else [0, 0, c1, c0] if c1 else [0, 0, 0, 0]
            own[1] = [x + y for x, y in zip(own[1], beside)]
        yield {"host": [h for h, _ in found], "items": [x for _, x in found], "pages": [n for n, _ in found.values()],
               **{f"c{k}": [c[k] for _, c in found.values()] for k in range(4)}}

    def collect(cols):
        found: dict[tuple, list] = {}
        for host, pages, sizes, text in zip(cols["host"], cols["pages"].to_pylist(), cols["sizes"].to_pylist(), cols["items"]):
            items = [[g, t, False, 1, False] for g, t in json.loads(text)]
            key = (host, json.dumps([g for g, *_ in items]))
            if key in found:
                own = found[key]
                found[key] = [own[0] + pages, own[1] + 1, [x + y for x, y in zip(own[2], sizes)], list(map(unite, own[3], items))]
            else:
                found[key] = [pages, 1, sizes, items]
        yield {"host": [h.decode() for h, _ in found], "pages": [x[0] for x in found.values()], "unlike": [x[1] for x in found.values()],
               "sizes": pa.array([x[2] for x in found.values()], pa.list_(pa.int64())), "items": [json.dumps(x[3]) for x in found.values()]}

    def merge(table: pa.Table) -> pa.Table:
        items = _merge_all([json.loads(x) for x in sorted(table.column("items").to_pylist())])
        return pa.table({"host": table.column("host")[:1], **{
            k: pa.array([sum(table.column(k).to_pylist())], pa.int64()) for k in ("pages", "unlike")},
            "sizes": pa.array([[sum(x) for x in zip(*table.column("sizes").to_pylist())]], pa.list_(pa.int64())),
            "items": pa.array([json.dumps(items)], pa.string())})

    def finish(cols):
        yield {"host": [h.decode() for h in cols["host"]], "pages": cols["pages"],
               "wrapper": [json.dumps(wrapper(json.loads(x), n, sizes)) for x, n, sizes in
                           zip(cols["items"], cols["unlike"].to_pylist(), cols["sizes"].to_pylist())]}

    rows = map_batches(pages.select(host_of(url).alias("host"), F.col(html).alias("html")), summarise,
                       "host string, items string, pages long, c0 long, c1 long, c2 long, c3 long")
    unlike = rows.groupBy("host", "items").agg(F.sum("pages").alias("pages"), F.array(*[F.sum(f"c{k}") for k in range(4)]).alias("sizes"))
    partial = map_batches(unlike.select("host", "pages", "sizes", "items"), collect, PARTIAL)
    while True:
        partial = stage(partial, "expressions")
        most = partial.groupBy("host").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return map_batches(partial, finish, "host string, pages long, wrapper string")
        groups = partial.groupBy("host").agg(F.ceil(F.count("*") / MERGED).alias("groups")).withColumnRenamed("host", "_host")
        partial = partial.join(groups, F.col("host") == F.col("_host")) \
            .withColumn("salt", F.pmod(F.xxhash64("items"), F.col("groups"))).drop("_host", "groups") \
            .groupBy("host", "salt").applyInArrow(merge, PARTIAL)


def extract(pages: DataFrame, wrappers: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            max_wrapper_mb: int = 64) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    use_small_batches(pages.sparkSession)
    size = wrappers.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0
    right = wrappers.select(F.col("host").alias("_host"), "wrapper")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(url).alias("host"))
    rows = rows.join(F.broadcast(right) if size <= max_wrapper_mb << 20 else right, F.col("host") == F.col("_host"), "left")

    def run(cols):
        known: dict[bytes, tuple] = {}
        texts = []
        for page, made in zip(cols["html"], cols["wrapper"]):
            if not page or made is None:
                texts.append("")
                continue
            if made not in known:
                known[made] = read_wrapper(made)
            texts.append(main_text(page.decode("utf-8", "replace"), known[made]))
        yield {"page_id": cols["page_id"], "url": [u.decode() if u is not None else None for u in cols["url"]],
               "text": texts, "n_chars": [len(t) for t in texts]}

    kind = rows.schema["page_id"].dataType.simpleString()
    return map_batches(rows.select("page_id", "url", "html", "wrapper"), run, f"page_id {kind}, url string, text string, n_chars long")


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, stage(infer(pages), "wrappers"))

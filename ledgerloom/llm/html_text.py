"""Main text of web pages by deducing each host's template from token equivalence classes.

Method. A page is a sequence of tokens: its elements, told apart by the path of open elements, and its texts, told apart by
path and content. A token's occurrence vector says how often it occurs on each page of the host; tokens with the same
vector form a class. A class is valid if it is large (`CLASS_TOKENS` tokens or more), frequent (on a fixed share of the host's pages) and nested:
for the elements in it, that the elements around them are in it or in another valid class. Valid classes make up the template. A block of text lies in the slot of its
nearest template element, and a slot's text is counted over all pages of the host. Where the host's pages have an article or main element that is in the template, its slots are extracted, else
the slot with the most text and those inside it. Texts that are themselves template tokens are left out. Pages that are alike count once, so that copies of one article do not
become a template.

Elements that are furniture by their nature (menus, footers, forms, ...) are never extracted; a form is none if it holds the article or most of the page's text. Names of furniture count
outside an article; inside one a class does, an id only if it names reader comments, since ids of sections and headings are anchors. Where a host has neither an article nor a slot, all that
is not furniture is extracted.

Vectors are compared by their length and an order-free sum of hashes of (page, count), which is taken in parts before the shuffle: a
host with a third of all pages costs each task one row per token. A host's template is one row, as large as a page.
Pages are read twice; they meet their template by a join on the host, which may be split.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.shared import annotate, write_shared
from ledgerloom.llm.url_filter import url_host

CLASS_TOKENS = 2
ELEMENT_SHARE = 0.5
TEXT_SHARE = 0.6
#: With fewer different pages a text on most of them proves nothing.
TEXT_PAGES = 10

_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub "
                    "sup time tt u var wbr".split())
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|noscript|template|svg|iframe|object|canvas|textarea"
_MAIN = frozenset(["article", "main"])
_COMMENTS_ID = re.compile(r"(?i)(?:reader-?|user-?)?(?:comments?|comment-?list|comment-?section|disqus(?:_thread)?|respond)")
#: A form with more than this share of a page's text is the page.
FORM_SHARE = 0.5
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_FURNITURE = frozenset("head nav footer aside menu dialog button select fieldset audio video".split())
_FURNITURE_NAME = re.compile(
    r"(?i)(?:^|[\s_-])(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|side|aside|cookies?|consent|gdpr|notices?|alert|banner|ads?|advert\w*|sponsor\w*|promo\w*|"
    r"comments?|commentlist|disqus|discussion|replies|responses|respond|share|sharing|social|related|recommended|breadcrumbs?|newsletter|subscribe|signup|login|search|widget|popup|modal|"
    r"overlay|toolbar|pagination|pager|skip|hidden)(?:$|[\s_-])")
_FURNITURE_ROLE = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<more>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


class Block(NamedTuple):
    path: str
    text: str
    main: bool  # inside an article or main element
    furniture: bool


class _Open(NamedTuple):
    tag: str
    path: str
    main: bool
    furniture: bool
    form: int  # which form of the page it is in, 0 for none


def _label(tag, more, inside):
    """The element's name with its class and id, and whether they call it page furniture; `inside` an article most ids do not."""
    if not more or more.isspace():
        return tag, False
    names, furniture = [], False
    for m in _ATTRIBUTE.finditer(more):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            names.append(re.sub(r"\d{2,}", "0", " ".join(value.split())))
            if name == "id" and (inside or tag in _HEADINGS):
                furniture |= _COMMENTS_ID.fullmatch(value.strip()) is not None
            else:
                furniture |= _FURNITURE_NAME.search(value) is not None
        elif name == "role":
            furniture |= value.lower() in _FURNITURE_ROLE
        else:
            furniture |= value.lower() != "false" and (name == "hidden" or value.lower() == "true")
    return ".".join([tag, *names]), furniture


def page_parts(page: str) -> tuple[list[str], list[Block]]:
    """The paths of all block elements, and the text blocks, in page order. Inline elements are part of their block."""
    elements, blocks, pieces, forms = [], [], [], [0]
    opened = [_Open("", "", False, False, 0)]

    def flush():
        if pieces:
            text = "".join(pieces)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            pieces.clear()
            if text:
                top = opened[-1]
                blocks.append((Block(top.path, text, top.main, top.furniture), top.form))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            pieces.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if tag == "br":
                pieces.append(" ")
            continue
        flush()
        if m["close"]:
            for k in range(len(opened) - 1, 0, -1):
                if opened[k].tag == tag:
                    del opened[k:]
                    break
            continue
        if tag in _CLOSES_P and opened[-1].tag == "p":
            opened.pop()
        elif tag in _CLOSES_SAME and opened[-1].tag in _CLOSES_SAME[tag]:
            opened.pop()
        above = opened[-1]
        label, named = _label(tag, m["more"], above.main)
        main = above.main or tag in _MAIN and not above.furniture
        furniture = above.furniture or tag in _FURNITURE or (named and tag not in ("html", "body", "form")) or (tag == "header" and not above.main)
        if above.tag == "header" and above.main:  # of an article's own header only the headings are text
            furniture = furniture or tag not in _HEADINGS
        form = above.form
        if tag == "form" and not form:
            forms.append(len(forms))
            form = forms[-1]
        path = f"{above.path}/{label}"
        elements.append(path)
        if tag not in _EMPTY:
            opened.append(_Open(tag, path, main, furniture, form))
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return elements, _without_forms(blocks)


def _without_forms(blocks: list[tuple[Block, int]]) -> list[Block]:
    """The blocks, those in a form being furniture unless the form holds an article that begins in it, or most of the text."""
    if not any(form for _, form in blocks):
        return [b for b, _ in blocks]
    sizes: dict[int, int] = {}
    for b, form in blocks:
        if not b.furniture:
            sizes[form] = sizes.get(form, 0) + len(b.text)
    whole = sum(sizes.values())
    page_like = {f for f, n in sizes.items() if n > FORM_SHARE * whole}
    return [b if not form or form in page_like else b._replace(furniture=True) for b, form in blocks]


def text_token(block: Block) -> int:
    h = xxhash.xxh64_intdigest(f"{block.path}\x1f{block.text}".encode("utf-8", "replace"))
    return h - (1 << 64) if h >> 63 else h


_TOKENS = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("page", T.LongType()), T.StructField("path", T.StringType()),
    T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("chars", T.LongType())])


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, page, path, text_hash, n, chars) for each token of each page (host, html). An element has no text_hash; `page` is a
    hash of the page's tokens; `chars` is the length of a text that is no furniture, else 0."""
    def run(stream):
        for batch in stream:
            out = {name: [] for name in _TOKENS.names}
            for host, source in zip(batch.column(0), batch.column(1)):
                elements, blocks = page_parts(source.as_py() or "")
                counts: dict[tuple[str, int | None], int] = {}
                tokens = [(b.path, text_token(b)) for b in blocks]
                chars = {t: 0 if b.furniture else len(b.text) for t, b in zip(tokens, blocks)}
                for token in [*((e, None) for e in elements), *tokens]:
                    counts[token] = counts.get(token, 0) + 1
                page = xxhash.xxh64_intdigest(repr(list(counts.items())).encode("utf-8", "replace")) >> 1
                for (path, text_hash), n in [(("", None), 1), *counts.items()]:
                    for name, value in zip(_TOKENS.names, (host.as_py(), page, path, text_hash, n, chars.get((path, text_hash), 0))):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], pa.string() if f.dataType == T.StringType() else pa.int64()) for f in _TOKENS], _TOKENS.names)

    return pages.mapInArrow(run, _TOKENS)


def _around(path):
    """The path of the element around."""
    return F.regexp_replace(path, "/[^/]*$", "")


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, elements, texts, slot): the paths and text hashes of each host's template, and the element whose slot has most text, from pages (host, html)."""
    tokens = page_tokens(pages).distinct()
    mark = F.xxhash64("page", "n").cast("decimal(20,0)")
    vectors = write_shared(tokens.groupBy("host", "path", "text_hash").agg(
        F.count("*").alias("pages"), F.sum("n").alias("times"), F.sum(mark).alias("vector"), F.sum(F.col("n") * F.col("chars")).alias("chars")), "html-vectors")
    sizes = vectors.where("path = '' and text_hash is null").select("host", F.col("pages").alias("host_pages"))
    is_text = F.col("text_hash").isNotNull()
    shared = vectors.where(~is_text | (F.col("pages") >= TEXT_PAGES))  # what only a few pages have does not travel
    frequent = shared.join(sizes, "host").where(
        F.when(is_text, F.col("pages") >= TEXT_SHARE * F.col("host_pages"))
        .otherwise(F.col("pages") >= ELEMENT_SHARE * F.col("host_pages")))
    classes = frequent.groupBy("host", "vector", "pages", "times").agg(
        F.collect_set(F.when(~is_text, F.col("path"))).alias("elements"), F.collect_set("text_hash").alias("texts"))
    large = classes.where(F.size("elements") + F.size("texts") >= CLASS_TOKENS)
    merged = large.groupBy("host").agg(F.flatten(F.collect_list("elements")).alias("elements"), F.flatten(F.collect_list("texts")).alias("texts"))
    nested = F.filter("elements", lambda p: (p == "") | F.array_contains("elements", _around(p)))
    templates = write_shared(merged.select("host", nested.alias("elements"), "texts"), "html-template-tokens")
    return templates.join(main_slots(vectors, templates), "host", "left")


def main_slots(vectors: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, slot): the template element that is the nearest one around most of the host's text; of equal ones the first by path.

    Text is added up by path before it meets the elements around it, so a path counts once however many pages have it.
    """
    by_path = vectors.where("text_hash is not null and chars > 0").groupBy("host", "path").agg(F.sum("chars").alias("chars"))
    parts = F.split("path", "/")
    around = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    reached = by_path.where("path <> ''").select("host", "path", "chars", F.explode(around).alias("element"))
    elements = templates.select("host", F.explode(F.array_distinct("elements")).alias("element"))
    nearest = reached.join(elements, ["host", "element"]).groupBy("host", "path", "chars").agg(F.max_by("element", F.length("element")).alias("slot"))
    return nearest.groupBy("host", "slot").agg(F.sum("chars").alias("chars")).groupBy("host").agg(
        F.min(F.struct(-F.col("chars"), F.col("slot")))["slot"].alias("slot"))


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def _under(path: str, root: str) -> bool:
    return path == root or path.startswith(f"{root}/")


def article_text(page: str, elements: frozenset[str], texts: frozenset[int], slot: str | None) -> str:
    """The blocks of the article's slots, one a line."""
    _, blocks = page_parts(page)
    slots = [b for b in blocks if not b.furniture and text_token(b) not in texts] if texts else [b for b in blocks if not b.furniture]
    roots = {p for p in elements if _tag(p) in _MAIN}
    found = [b for b in slots if b.main and any(_under(b.path, r) for r in roots)] or [b for b in slots if b.main]
    if not found and slot:
        found = [b for b in slots if _in_slot(b.path, slot, elements)]
    return "\n".join(b.text for b in found or slots)


def _in_slot(path: str, slot: str, elements: frozenset[str]) -> bool:
    """Whether a block lies in the slot or one inside it. Of the slots inside the whole body only the headings' are the article's."""
    if not _under(path, slot):
        return False
    if _tag(slot) not in ("body", "html"):
        return True
    near = path
    while near and near not in elements:
        near = near.rpartition("/")[0]
    return near == slot or _tag(near) in _HEADINGS


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars.

    A null page is an empty one and has an empty text. Pages without a host (null urls among them) share a template like those of any host. Rows that repeat a
    page all come back, and count once for the template. Pages of any length are read whole. Other columns are not read. An empty table gives an empty result.
    """
    slim = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), url_host(F.col(url)).alias("host"), F.coalesce(F.col(source), F.lit("")).alias("html"))
    templates = write_shared(host_templates(slim.select("host", "html")), "html-templates")
    met = slim.join(templates, "host", "left").drop("host")

    def prepare():
        def work(sources, elements, texts, slots):
            made = [article_text(s.as_py(), frozenset(e.as_py() or ()), frozenset(t.as_py() or ()), slot.as_py())
                    for s, e, t, slot in zip(sources, elements, texts, slots)]
            made = pa.array(made, pa.string())
            return pa.StructArray.from_arrays([made, pc.utf8_length(made).cast(pa.int64())], ["text", "n_chars"])

        return work

    result = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return annotate(met, ["html", "elements", "texts", "slot"], result, "found", prepare).select("page_id", "url", "found.text", "found.n_chars")

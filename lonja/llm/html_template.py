"""Main text of web pages by template deduction over the pages of a host.

Tokens. A page is read into container tags and blocks of text. A tag is told from others by its path: the open containers with their
class and id. Blocks in regions that are marked as something else than the article (``DROPPED`` elements, ``MARKS`` in class, id or
role) are no blocks at all.

Equivalence classes. A token's occurrence vector over the pages of its host says how often it stands on each page. It is kept as a
combination (exclusive or) of hashes of (page, number), so that vectors of any length are made by partial aggregation and a host with a
third of all pages is a few numbers per token and task. Tokens with equal vectors form a class. A class is valid if each of its tokens stands once on each of
its pages, on at least ``LEAST_PAGES`` pages, with at least one container tag outside of articles (pages that copy each other
share blocks of text, but no part of the layout of their own), and if its tags come in one order: a second pass over the pages takes
out tags that do not. Classes nest through the paths of their tags; together they are the host's template.

Slots. What no template token covers lies in slots, named by the nearest enclosing tag of the template. A block of text in a valid class is
part of the template and goes, if at least ``LEAST_CONTENTS`` different contents surely stand around it and the class's text is no more than
half of an average page's (else the pages are versions of one text). Of a page with an article (or else a main) element, the slots inside
it are extracted; of one without, the host's slots that hold most text outside links.

Three passes over the pages (count, order, extract), each with one small row per host joined to the pages; Spark broadcasts these rows
where it measures them to be small and shuffles otherwise. Nothing else of a page is moved, and no group of pages is collected.

Defined cases: a null or empty html gives an empty text; a null url belongs to the empty host; a page whose host has too few pages, or
only versions of one text, is extracted by its own marks alone; repeated rows are pages of their own, with equal results; markup that
is cut off ends where it ends; text in no block element is a block; a line break element is white space; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import table
from lonja.llm.hosts import address
from lonja.operators.staging import Stage

LEAST_PAGES = 4
LEAST_CONTENTS = 3
HELD = 100_000
MAIN_SHARE = 0.2  # of the text in a host's largest slot

# Fixed values of the markup language, and usual names of page regions.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noscript noembed noframes xmp".split())
DROPPED = frozenset(
    "head nav footer aside form script style title textarea iframe noscript noembed noframes xmp template svg math object canvas audio video "
    "select button dialog menu header".split()
)
CONTAINERS = frozenset(
    "html body main article section div nav header footer aside form table tbody thead tfoot tr td th ul ol dl menu blockquote figure details "
    "dialog fieldset center address search hgroup".split()
)
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr figcaption summary legend caption option".split())
CLOSES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}}
SAME = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}}
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar header masthead footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login related recommended recommendations share sharing social comment comments commentlist respond reply replies "
    "disqus pagination pager toolbar widget contentinfo complementary".split()
)
NO_MARK = frozenset("has with without no not is".split())

_TAG = re.compile(
    r"<(?:!--(?:>|->|.*?--!?>|.*)|[!?][^>]*+(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]+|\"[^\"]*\"|'[^']*')*+)>"
    r"|(/?)([A-Za-z][^\s/>]*)([^>]*+)>|/?[A-Za-z][^>]*+\Z|/[^A-Za-z][^>]*+>)",
    re.S,
)
_NAMED = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_MAIN, _ARTICLE = 1, 2


@dataclass
class Block:
    text: str
    links: int  # of its code points, those inside links
    level: int  # inside an article, a main element or neither
    chain: tuple[int, ...]  # the enclosing containers, outermost first


@dataclass
class Page:
    tags: list[tuple[int, bool]] = field(default_factory=list)  # (token, inside an article or main element) in page order
    blocks: list[Block] = field(default_factory=list)

    def level(self) -> int:
        return max((block.level for block in self.blocks), default=0)

    def contents(self) -> list[Block]:
        """The blocks of the article, or of the main element, or all."""
        level = self.level()
        return [block for block in self.blocks if block.level == level]


def _marks(names: dict[str, str]) -> bool:
    for name in ("class", "id", "role"):
        for value in names.get(name, "").lower().split():
            parts = re.split(r"[^a-z0-9]+", value)
            if not NO_MARK.intersection(parts) and MARKS.intersection(parts):
                return True
    return False


class _Reader:
    """Reads a page. The stack holds (name, dropped, level, chain, link)."""

    def __init__(self) -> None:
        self.page, self.stack = Page(), [("", False, 0, (), False)]
        self.pieces: list[str] = []
        self.links = 0

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                _, _, level, chain, _ = self.stack[-1]
                self.page.blocks.append(Block(text, min(self.links, len(text)), level, chain))
            self.pieces, self.links = [], 0

    def text(self, raw: str) -> None:
        _, dropped, _, _, link = self.stack[-1]
        if raw and not dropped:
            self.pieces.append(references.unescape(raw) if "&" in raw else raw)
            if link:
                self.links += len(raw.strip())

    def close(self, wanted: set[str], barrier: set[str] | frozenset[str]) -> None:
        """Closes the innermost open element of these names, unless one of ``barrier`` lies further in."""
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.stack[depth][0]
            if name in wanted:
                del self.stack[depth:]
                return
            if name in barrier:
                return

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            return self.text(" ")
        if name in BLOCKS:
            self.end_block()
            self.close({"p"}, CONTAINERS)
            if name in CLOSES:
                self.close(SAME.get(name, {name}), CLOSES[name])
        if name in VOID:
            return
        _, dropped, level, chain, link = self.stack[-1]
        names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(attributes)} if attributes else {}
        if not dropped:
            layout = name in ("html", "body", "main")
            dropped = name in DROPPED and not (name == "header" and level == _ARTICLE)
            dropped = dropped or bool(names) and not layout and not (level == _ARTICLE and name == "header") and _marks(names)
        if not dropped:
            role = names.get("role", "").lower()
            if name == "article" or role == "article" or names.get("itemprop", "").lower() == "articlebody":
                level = _ARTICLE
            elif name == "main" or role == "main":
                level = max(level, _MAIN)
            if name in CONTAINERS:
                token = xxhash.xxh64_intdigest(f"{chain[-1] if chain else 0} {name}.{names.get('class', '')}#{names.get('id', '')}") >> 1
                chain = (*chain, token)
                self.page.tags.append((token, level > 0 and name not in ("main", "article")))
        self.stack.append((name, dropped, level, chain, link or name == "a"))

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.end_block()
        if name in CONTAINERS:
            self.close({name}, {"td", "th", "template"} - {name} if name not in ("table", "tr", "tbody", "thead", "tfoot") else {"table"} - {name})
        else:
            self.close({name}, CONTAINERS)


def read(html: str | None) -> Page:
    reader, html, at = _Reader(), html or "", 0
    while match := _TAG.search(html, at):
        reader.text(html[at : match.start()])
        at = match.end()
        closing, name, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            reader.end(name)
            continue
        reader.start(name, attributes)
        if name in RAW:
            found = _RAW_END[name].search(html, at)
            at = found.start() if found else len(html)
    reader.text(html[at:])
    reader.end_block()
    return reader.page


def _block_token(block: Block) -> int:
    return xxhash.xxh64_intdigest(block.text, seed=block.chain[-1] if block.chain else 0) >> 1


# ---- passes over pages


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class _Sums:
    """Rows of sums by key, sent when there are many."""

    def __init__(self, schema: pa.Schema, keys: int):
        self.schema, self.keys, self.rows = schema, keys, {}

    def batch(self) -> pa.RecordBatch:
        rows = [[*key, *row] for key, row in self.rows.items()]
        self.rows = {}
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(self.schema)], schema=self.schema)


_COUNTED = "host long, token long, kind int, vector long, pages long, times long, place double, mask long, length long, around long"
_ORDERED = "host long, token long, wrong long, chars long, links long"
TAG, INSIDE, TEXT, EVERY = range(4)  # kinds of tokens: a container, one inside an article, a block of text, the page itself


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (one.split() for one in ddl.split(", "))])


def _counts(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: vector, pages, occurrences, sum of places, contents around it, its length and the length of what is around."""
    sums, number = _Sums(_arrow(_COUNTED), 2), (TaskContext.get().partitionId() + 1) << 40
    for batch in incoming:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            page, number = read(html.as_py()), number + 1
            blocks = page.contents()
            around = sum(len(block.text) for block in blocks)
            mask = 1 << (xxhash.xxh64_intdigest("\n".join(block.text for block in blocks)) % 62)
            found: dict[int, list[int]] = {0: [EVERY, 1, 0, 0]}
            for place, (token, inside) in enumerate(page.tags):
                found.setdefault(token, [INSIDE if inside else TAG, 0, place, 0])[1] += 1
            for block in blocks:
                found.setdefault(_block_token(block), [TEXT, 0, 0, len(block.text)])[1] += 1
            for token, (kind, times, place, length) in found.items():
                row = sums.rows.setdefault((host, token), [kind, 0, 0, 0, 0.0, 0, 0, 0])
                row[1] ^= _signed(xxhash.xxh64_intdigest(b"%d %d" % (number, times)))
                row[2] += 1
                row[3] += times
                row[4] += place
                row[5] |= mask
                row[6] = max(row[6], length)
                row[7] += around
        if len(sums.rows) >= HELD:
            yield sums.batch()
    yield sums.batch()


def _orders(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and tag of its template: pages on which the tag comes too late or too early, and text in its slot on pages without marks."""
    sums = _Sums(_arrow(_ORDERED), 2)
    for batch in incoming:
        for host, html, tags in zip(batch.column("host").to_pylist(), batch.column("html"), batch.column("tags").to_pylist()):
            if not tags:
                continue
            page, order = read(html.as_py()), {token: i for i, token in enumerate(tags)}
            last = -1
            for token, _ in page.tags:
                place = order.get(token)
                if place is not None:
                    row = sums.rows.setdefault((host, token), [0, 0, 0])
                    row[0] += place < last
                    last = max(last, place)
            if page.level() == 0:
                for block in page.blocks:
                    slot = _slot(block, order)
                    row = sums.rows.setdefault((host, slot), [0, 0, 0])
                    row[1] += len(block.text)
                    row[2] += block.links
        if len(sums.rows) >= HELD:
            yield sums.batch()
    yield sums.batch()


def _slot(block: Block, tags) -> int:
    return next((token for token in reversed(block.chain) if token in tags), 0)


def extract(html: str | None, tags: list[int] | None, texts: list[int] | None, slots: list[int] | None) -> list[str]:
    """The blocks of a page's main text, given its host's template: tags, texts and, for pages without marks, main slots."""
    page = read(html)
    blocks = page.contents()
    if slots and page.level() == 0:
        known, wanted = set(tags or ()), set(slots)
        blocks = [block for block in blocks if _slot(block, known) in wanted] or blocks
    if texts:
        known = set(texts)
        blocks = [block for block in blocks if _block_token(block) not in known]
    return [block.text for block in blocks]


def _extracted(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    for batch in incoming:
        given = [batch.column(name).to_pylist() for name in ("tags", "texts", "slots")]
        found = ["\n\n".join(extract(html.as_py(), *template)) for html, *template in zip(batch.column("html"), *given)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], schema=schema)


# ---- templates


def templates(pages: DataFrame, stage: Stage) -> DataFrame:
    """host, tags, texts, slots: the template of each host. ``pages`` has host (a number) and html."""
    counted = pages.select("host", "html").mapInArrow(_counts, _COUNTED).groupBy("host", "token", "kind").agg(
        F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.sum("place").alias("place"),
        F.bit_or("mask").alias("mask"), F.max("length").alias("length"), F.sum("around").alias("around"),
    )
    once = (F.col("pages") == F.col("times")) & (F.col("pages") >= LEAST_PAGES)
    counted = stage.keep(counted.where(once), "counted")
    tag, text = F.col("kind").isin(TAG, EVERY), F.col("kind") == TEXT
    classes = counted.groupBy("host", "vector").agg(
        F.count_if(tag).alias("n_tags"), F.sum(F.when(text, F.col("length"))).alias("said"), F.max(F.col("around") / F.col("pages")).alias("around"),
        F.max(F.bit_count("mask")).alias("contents"),
    )
    telling = (F.col("contents") >= LEAST_CONTENTS) & (2 * F.coalesce("said", F.lit(0)) <= F.col("around"))
    valid = classes.where("n_tags > 0").select("host", "vector", telling.alias("telling"))
    members = counted.join(valid, ["host", "vector"])
    ordered = F.sort_array(F.collect_list(F.when(F.col("kind") == TAG, F.struct((F.col("place") / F.col("pages")).alias("at"), "token"))))
    texts = F.collect_set(F.when(text & F.col("telling"), F.col("token")))
    first = stage.keep(members.groupBy("host").agg(ordered["token"].alias("tags"), texts.alias("texts")), "first")
    seen = pages.select("host", "html").join(first.select("host", "tags"), "host").mapInArrow(_orders, _ORDERED)
    seen = stage.keep(seen.groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("wrong", "chars", "links")]), "orders")
    plain = F.col("chars") - F.col("links")
    most = seen.groupBy("host").agg(F.max(plain).alias("most"))
    large = (F.col("chars") > 0) & (plain >= MAIN_SHARE * F.col("most")) & (2 * F.col("links") <= F.col("chars"))
    judged = seen.join(most, "host").groupBy("host").agg(
        F.collect_set(F.when(F.col("wrong") > 0, F.col("token"))).alias("wrong"), F.collect_set(F.when(large, F.col("token"))).alias("slots")
    )
    final = first.join(judged, "host", "left").select(
        "host", F.array_except("tags", F.coalesce("wrong", F.array().cast("array<bigint>"))).alias("tags"), "texts", "slots"
    )
    return stage.keep(final, "templates")


def main_texts(pages: DataFrame, stage: Stage) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html)."""
    host, _ = address(F.col("url"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.xxhash64(host).alias("host"),
        F.col("html").cast("string").alias("html"),
    )
    found = rows.join(templates(rows, stage), "host", "left")
    return found.mapInArrow(_extracted, "page_id long, url string, text string")


def op12_template_extraction(spark, sf_dir: str) -> DataFrame:
    found = main_texts(table(spark, sf_dir, "pages"), Stage(spark, "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))

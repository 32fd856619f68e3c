"""Main text of web pages by wrapper induction.

Pages of one host are clustered by their shape, the parts that stand side by side where the
page first branches, and each is aligned with a page of its shape by simple tree matching.
Over all pages of a shape, nodes whose text stays the same become template and nodes whose
text varies become slots; all slots together are the main text. Parts that their own tag or
class calls navigation, advert, comment and the like are never prose, but the names of
an element that holds the article do not count, nor do names inside an article that may as
well be those of its subject.
"""

import html as entities
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import StringType

from tempestry.llm.common import emit
from tempestry.llm.urls import host_and_path
from tempestry.session import Scratch

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(script|style|noscript|template|svg|iframe|textarea|select|object)\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)
      | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>
      | <[!?/][^>]*(?:>|\Z)
      | <[a-zA-Z][^>]*(?:>|\Z)""",
    re.VERBOSE | re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)

#: Elements that hold blocks; others stand inside a block.
BLOCKS = frozenset(
    "html head body title nav header footer aside main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd"
    " table thead tbody tfoot tr td th caption blockquote pre figure figcaption form fieldset legend address details"
    " summary menu dialog center button label".split()
)
BREAKS = frozenset(("br", "hr"))
#: Elements that a new one of the kind closes, up to the element that holds them.
CLOSES = {
    "p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"),
    "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
}
HOLDS = frozenset("ul ol dl table tbody thead tfoot html body div article section main nav aside footer header form".split())
#: Elements that hold the article; their names say nothing of their own text.
HOLDERS = frozenset("html body main article".split())
#: Share of a page's varying prose from which on an element holds the article.
MOST = 0.7
#: Elements and class or id words that say that a part is no prose of the article.
APART = frozenset("head title nav footer aside form menu dialog button fieldset label".split())
APART_WORDS = re.compile(
    r"(?:^|[^a-z])(?:nav|navbar|navigation|menu|menus|header|masthead|footer|contentinfo|sidebar|complementary|aside"
    r"|ad|ads|advert[a-z]*|banner|promo[a-z]*|sponsor[a-z]*|cookie[a-z]*|consent|gdpr|notice|notices|alert|popup|modal"
    r"|comment|comments|commentlist|disqus|respond|reply|replies|form|search|login|signup|subscribe|newsletter|share|social|related"
    r"|breadcrumb[a-z]*|pagination|pager|widget|toolbar|skip)(?:$|[^a-z])"
)
#: Those of them that inside an article may be its subject: there the alignment decides.
SUBJECT_WORDS = re.compile(r"(?<![a-z])(?:alert|share|search|social|related|widget|popup|modal|skip|reply|login)(?![a-z])")
#: Names of the readers' discussion, which may be longer than the article.
DISCUSSION = re.compile(r"(?:^|\.)(?:comments?|commentlist|disqus|respond|reply|replies)(?:$|[-_.])")

#: Elements nested deeper count as part of the one at this depth, unless they are apart.
DEEPEST = 256


def parse(page):
    """``(labels, parents, blocks)``: elements in page order and texts (element, text)."""
    labels, parents, blocks = ["#page"], [-1], []
    open_, opened, waiting, at = [("#page", 0)], Counter(), [], 0  # open_: tags and the nodes that take their text

    def flush():
        if waiting:
            text = " ".join(entities.unescape("".join(waiting)).split())
            if text:
                blocks.append((open_[-1][1], text))
            waiting.clear()

    def close(i):
        opened.subtract(tag for tag, _ in open_[i:])
        del open_[i:]

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            waiting.append(page[at : m.start()])
        at = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BREAKS:
            flush()
        elif tag in BLOCKS:
            flush()
            if m.group(2):
                if opened[tag] > 0:
                    close(next(i for i in range(len(open_) - 1, 0, -1) if open_[i][0] == tag))
                continue
            closes = CLOSES.get(tag, ("p",))
            for i in range(len(open_) - 1, 0, -1):
                name = open_[i][0]
                if name in closes:
                    close(i)
                    if name == tag or tag not in CLOSES:
                        break
                elif name in HOLDS:
                    break
            names, said = [], m.group(4)
            if said:
                names = sorted({w for _, v in _ATTRIBUTE.findall(said) for w in v.strip("\"'").lower().split()})
                if _HIDDEN.search(said):
                    names.append("#hidden")
            label, node = ".".join([tag, *names]), open_[-1][1]
            if len(open_) < DEEPEST or (apart(label) and not apart(labels[node])):
                labels.append(label)
                parents.append(node)
                node = len(labels) - 1
            open_.append((tag, node))
            opened[tag] += 1
    waiting.append(page[at:])
    flush()
    return labels, parents, blocks


@lru_cache(10_000)
def named_apart(label):
    """Whether only its names, or being a form, say that an element is no prose."""
    tag, _, names = label.partition(".")
    return not always_apart(label) and (tag == "form" or tag not in HOLDERS and bool(APART_WORDS.search(names)))


@lru_cache(10_000)
def always_apart(label):
    tag, _, names = label.partition(".")
    return tag in APART and tag != "form" or "#hidden" in names


@lru_cache(10_000)
def maybe_subject(label):
    """Whether an element named apart would not be without names that may be a subject."""
    tag, _, names = label.partition(".")
    return tag != "form" and not APART_WORDS.search(SUBJECT_WORDS.sub("-", names))


def apart(label):
    """Whether an element of this label is no prose by its own word."""
    return always_apart(label) or named_apart(label)


def apart_all(labels, parents, trusted=()):
    """Which elements are apart, by their own word or that of one around them.

    A header is apart unless an article or main element holds it, and so are names that
    may be a subject. The names of ``trusted`` elements do not count.
    """
    out, inside = [False] * len(labels), [False] * len(labels)
    for i in range(1, len(labels)):
        up, label = parents[i], labels[i]
        tag = label.partition(".")[0]
        inside[i] = inside[up] or tag in ("article", "main")
        named = named_apart(label) and i not in trusted and not (inside[up] and maybe_subject(label))
        own = always_apart(label) or named
        out[i] = out[up] or own or (tag == "header" and not inside[up])
    return out


def holding(labels, parents, blocks):
    """Elements named apart that nevertheless hold the article.

    Such an element holds most of the prose in ``blocks``, is no discussion, and no
    article or main element beside it has prose.
    """
    named = {i for i, label in enumerate(labels) if named_apart(label)}
    trusted = set()
    if not named:
        return trusted
    off, total = apart_all(labels, parents, named), [0] * len(labels)
    for node, text in blocks:
        if not off[node]:
            total[node] += len(text)
    for i in range(len(labels) - 1, 0, -1):
        total[parents[i]] += total[i]
    for i in range(1, len(labels)):  # from the outside in
        if i not in named or not total[i] or total[i] < MOST * total[0] or DISCUSSION.search(labels[i].partition(".")[2]):
            continue
        around, up = set(), i
        while up >= 0:
            around.add(up)
            up = parents[up]
        off = apart_all(labels, parents, trusted)
        beside = [False] * len(labels)
        for k in range(1, len(labels)):
            beside[k] = beside[parents[k]] or (k not in around and labels[k].partition(".")[0] in ("article", "main"))
        if not any(beside[node] and not off[node] for node, _ in blocks):
            trusted.add(i)
    return trusted


def _children(parents):
    out = [[] for _ in parents]
    for i, p in enumerate(parents):
        if p >= 0:
            out[p].append(i)
    return out


def _classes(labels, below, known):
    """One number per node; nodes of equal labels and children have the same."""
    out = [0] * len(labels)
    for i in range(len(labels) - 1, -1, -1):
        out[i] = known.setdefault((labels[i], tuple(out[k] for k in below[i])), len(known))
    return out


def _rows(gains, columns, froms, first):
    """Rows of the table of best matches after ``first``, one for each row of ``froms``.

    A row is the greater of skipping and matching at each place, and then of all to its left.
    """
    out = [first]
    for i in froms:
        row = first.copy()
        row[1:] = np.maximum(out[-1][1:], out[-1][:-1] + gains[i][columns])
        out.append(np.maximum.accumulate(row))
    return out


def _sequence(gains, rows, columns, pairs):
    """Size of the largest match in order of two lists, and its places where ``pairs`` is set.

    ``gains[rows[i]][columns[k]]`` is what i and k bring. Every so many rows of the table
    are kept and the others made again on the way back, so memory stays small.
    """
    step = max(int(len(rows) ** 0.5), 16)
    kept, last = [], np.zeros(len(columns) + 1, dtype=np.int64)
    for at in range(0, len(rows), step):
        kept.append(last)
        last = _rows(gains, columns, rows[at : at + step], last)[-1]
    found, k = [], len(columns)
    for at in range((len(rows) - 1) // step * step, -1, -step) if pairs else ():
        part = _rows(gains, columns, rows[at : at + step], kept.pop())
        i = len(part) - 1
        while i and k:
            both = gains[rows[at + i - 1]][columns[k - 1]]
            if both and part[i][k] == part[i - 1][k - 1] + both:
                found.append((at + i - 1, k - 1))
                i, k = i - 1, k - 1
            elif part[i][k] == part[i - 1][k]:
                i -= 1
            else:
                k -= 1
    return int(last[-1]), found


@lru_cache(20_000)
def align(template, page):
    """Simple tree matching: the template's node for each node of the page, or -1.

    Both are ``(labels, parents)`` tuples. Nodes match with their parents only and in
    order; the match with the most nodes is taken, at every size of the lists. Equal
    subtrees are one class, so each pair of classes is matched once. Pages of one shape
    are matched once.
    """
    (tl, tp), (pl, pp) = template, page
    below_t, below_p, known = _children(tp), _children(pp), {}
    class_t, class_p = _classes(tl, below_t, known), _classes(pl, below_p, known)
    size = {}

    def lists(a, b, pairs):
        """Size and pairs of the largest match of the children of a and b."""
        left, right, total, found = below_t[a], below_p[b], 0, []
        # equal subtrees at either end match each other in a largest match
        i, n = 0, min(len(left), len(right))
        while i < n and class_t[left[i]] == class_p[right[i]]:
            i += 1
        k = 0
        while k < n - i and class_t[left[-1 - k]] == class_p[right[-1 - k]]:
            k += 1
        ends = [*zip(left[:i], right[:i]), *zip(left[len(left) - k :], right[len(right) - k :])]
        total, left, right = sum(match(x, y) for x, y in ends), left[i : len(left) - k], right[i : len(right) - k]
        if left and right:
            ones, others = {}, {}
            rows = [ones.setdefault(class_t[x], len(ones)) for x in left]
            columns = np.array([others.setdefault(class_p[y], len(others)) for y in right])
            some = {class_t[x]: x for x in left}
            named = {}
            for y in {class_p[y]: y for y in right}.values():
                named.setdefault(pl[y], []).append(y)
            gains = []
            for c in ones:
                gain = np.zeros(len(others), dtype=np.int64)
                for y in named.get(tl[some[c]], ()):
                    gain[others[class_p[y]]] = match(some[c], y)
                gains.append(gain)
            n, places = _sequence(gains, rows, columns, pairs)
            total += n
            found = [(left[x], right[y]) for x, y in places]
        return total, ends + found

    def match(a, b):
        if tl[a] != pl[b]:
            return 0
        key = class_t[a], class_p[b]
        if key not in size:
            size[key] = 1 + lists(a, b, False)[0]
        return size[key]

    to = [-1] * len(pl)
    todo = [(0, 0)] if tl[0] == pl[0] else []
    while todo:
        a, b = todo.pop()
        to[b] = a
        todo += lists(a, b, True)[1]
    return tuple(to)


def shape(labels, parents):
    return tuple(labels), tuple(parents)


def signature(labels, parents):
    """The shape of a page: the labels, each once, where its body first branches.

    Parts of one label count once, so the length of an article or a list does not matter.
    """
    below, at = _children(parents), 0
    for i, label in enumerate(labels):
        if label.partition(".")[0] == "body":
            at = i
            break
    path = []
    while len(kinds := {labels[k] for k in below[at]}) == 1 and len(below[at]) == 1:
        path += kinds
        at = below[at][0]
    return xxhash.xxh64_intdigest("\n".join([*path, "", *sorted(kinds)])) >> 1


_SHAPES = pa.schema([("host", pa.string()), ("shape", pa.int64()), ("n", pa.int64()), ("first", pa.int64())])


def _shapes(batches):
    """Shapes of the pages of each host, added up for each batch, with their smallest digest."""
    for batch in batches:
        seen = {}
        for host, page, digest in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "digest"))):
            key = host, signature(*parse(page)[:2])
            n, first = seen.get(key, (0, digest))
            seen[key] = n + 1, min(first, digest)
        if seen:
            rows = [(*key, *value) for key, value in seen.items()]
            yield emit(_SHAPES, **dict(zip(_SHAPES.names, zip(*rows))))


def _by_host(batch, known):
    """The templates of each row's host, converted once for each host of a batch."""
    hosts, column = batch.column("host").to_pylist(), batch.column("templates")
    known.clear()
    for i, host in enumerate(hosts):
        if host not in known:
            known[host] = [(t["shape"], shape(t["labels"], t["parents"])) for t in column[i].as_py()]
    return hosts


def _template_of(templates, labels, parents):
    """Place and tree of the template of a page: that of its shape, or else the first."""
    own = signature(labels, parents) if len(templates) > 1 else None
    at = next((i for i, (kind, _) in enumerate(templates) if kind == own), 0)
    return at, templates[at][1]


_SEEN = pa.schema(
    [("host", pa.string()), ("template", pa.int32()), ("node", pa.int32()), ("digest", pa.int64()), ("n", pa.int64())]
)


def _observe(batches):
    """Texts seen at each template node, added up for each batch of pages.

    Node -1 stands for the prose of the whole page. Text of a node that the template
    lacks is a slot of its page and is not counted.
    """
    known = {}
    for batch in batches:
        seen = {}
        for host, page in zip(_by_host(batch, known), batch.column("html").to_pylist()):
            pl, pp, blocks = parse(page)
            at, template = _template_of(known[host], pl, pp)
            to = align(template, shape(pl, pp))
            off, texts = apart_all(pl, pp, holding(pl, pp, blocks)), {-1: []}
            never = apart_all(pl, pp, range(len(pl)))
            for node, text in blocks:
                if not off[node]:
                    texts[-1].append(text)
                if not never[node] and to[node] >= 0:
                    texts.setdefault(to[node], []).append(text)
            for node, parts in texts.items():
                key = host, at, node, xxhash.xxh64_intdigest(" ".join(parts)) >> 1
                seen[key] = seen.get(key, 0) + 1
        if seen:
            columns = [*zip(*seen), tuple(seen.values())]
            yield emit(_SEEN, **dict(zip(_SEEN.names, columns)))


_KEPT = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])


def main_text(page, templates, constants):
    """Main text of a page: its blocks in order that are neither template nor apart, one space between.

    ``templates`` pairs shapes with trees; ``constants`` has the constant nodes of each.
    """
    labels, parents, blocks = parse(page)
    at, template = _template_of(templates, labels, parents)
    to = align(template, shape(labels, parents))
    blocks = [(node, text) for node, text in blocks if to[node] not in constants[at]]
    off = apart_all(labels, parents, holding(labels, parents, blocks))
    return " ".join(text for node, text in blocks if not off[node])


def _extract(batches):
    known = {}
    for batch in batches:
        hosts, texts, constants = _by_host(batch, known), [], {}
        for i, (host, page) in enumerate(zip(hosts, batch.column("html").to_pylist())):
            if host not in constants:
                constants[host] = [frozenset(c or ()) for c in batch.column("constant")[i].as_py()]
            texts.append(main_text(page, known[host], constants[host]))
        out = emit(_KEPT, text=texts, n_chars=[len(t) for t in texts])
        own = [batch.column(c) for c in ("page_id", "url")]
        yield pa.RecordBatch.from_arrays([*own, *out.columns], names=["page_id", "url", *_KEPT.names])


def _templates(batches):
    schema = pa.schema(
        [("host", pa.string()), ("shape", pa.int64()), ("place", pa.int32()), ("labels", pa.list_(pa.string())), ("parents", pa.list_(pa.int32()))]
    )
    for batch in batches:
        trees = [parse(page)[:2] for page in batch.column("html").to_pylist()]
        own = {c: batch.column(c) for c in ("host", "shape", "place")}
        yield emit(schema, **own, labels=[t[0] for t in trees], parents=[t[1] for t in trees])


@pandas_udf(StringType())
def _hosts(urls: pd.Series) -> pd.Series:
    return urls.map(lambda u: host_and_path(u)[0])


def wrappers(pages: DataFrame, scratch: Scratch, same=0.8, least=3, own=10, most=16) -> DataFrame:
    """One row per host: its template trees by shape and the constant nodes of each.

    ``pages`` has host and html. The most common shape of a host has a template, and so have
    others of at least ``own`` pages, up to ``most`` in all; pages of other shapes go by the most
    common one. A template is the page of its shape with the smallest hash. A node is constant
    if one text stands there on a share of at least ``same`` of the template's pages, of which
    there are ``least``, and on more of them than copies of one page would explain. All pages
    are observed; what they show is added up before it is shuffled.
    """
    pages = pages.withColumn("digest", F.xxhash64("html"))
    shapes = pages.mapInArrow(_shapes, "host string, shape long, n long, first long").groupBy("host", "shape")
    shapes = shapes.agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    order = Window.partitionBy("host").orderBy(F.desc("n"), "shape")
    place = F.row_number().over(order) - 1
    chosen = shapes.withColumn("place", place).where((F.col("place") == 0) | ((F.col("n") >= own) & (F.col("place") < most)))
    chosen = scratch.save(chosen.select("host", "shape", "place", F.col("first").alias("digest")), "chosen")
    seeds = (
        pages.join(chosen, ["host", "digest"])
        .dropDuplicates(["host", "shape"])
        .select("host", "shape", "place", "html")
        .mapInArrow(_templates, "host string, shape long, place int, labels array<string>, parents array<int>")
        .groupBy("host")  # at most ``most`` rows
        .agg(F.sort_array(F.collect_list(F.struct("place", "shape", "labels", "parents"))).alias("templates"))
    )
    seeds = scratch.save(seeds, "templates")
    seen = (
        pages.select("host", "html").join(seeds, "host")
        .mapInArrow(_observe, "host string, template int, node int, digest long, n long")
        .groupBy("host", "template", "node", "digest")
        .agg(F.sum("n").alias("n"))
        .groupBy("host", "template", "node")
        .agg(F.sum("n").alias("pages"), F.max("n").alias("top"))
        .groupBy("host", "template")  # at most one row per node of the template
        .agg(F.collect_list(F.struct("node", "pages", "top")).alias("seen"))
    )

    def decide(batches):
        schema = pa.schema([("host", pa.string()), ("template", pa.int32()), ("nodes", pa.list_(pa.int32()))])
        for batch in batches:
            rows = []
            for found in batch.column("seen").to_pylist():
                whole = next(x for x in found if x["node"] < 0)
                rows.append(sorted(
                    x["node"] for x in found
                    if x["node"] >= 0 and whole["pages"] >= least
                    and x["top"] >= same * whole["pages"] and x["top"] > whole["top"]
                ))
            yield emit(schema, host=batch.column("host"), template=batch.column("template"), nodes=rows)

    decided = scratch.save(seen.mapInArrow(decide, "host string, template int, nodes array<int>"), "decided")
    by_place = decided.groupBy("host").agg(
        F.map_from_entries(F.collect_list(F.struct("template", "nodes"))).alias("found")
    )
    places = F.transform("templates", lambda t: F.try_element_at("found", t["place"]))
    return scratch.save(seeds.join(by_place, "host").select("host", "templates", places.alias("constant")), "wrappers")


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (main text, '' if none), n_chars.

    A null html is empty. Addresses without a host, null ones too, form one host. Null
    and repeated page ids are rows like any other, other columns are ignored. Prose that
    the template does not cover is kept where no element calls it apart. No rows give no
    rows.
    """
    scratch = Scratch(pages.sparkSession)
    plain = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), _hosts("url").alias("host"))
    found = wrappers(plain.select("host", "html"), scratch)
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return plain.join(found, "host").mapInArrow(_extract, f"{kinds}, text string, n_chars long")

"""Page captures to listing rows.

Flat patterns (links, title, paragraphs) stay JVM-side as regular expressions.
Where the position in the page matters, one Arrow task turns each page into an
array of its elements, and everything after that is Column work on the array;
or, where a few fields of a page are wanted, the task finds them in the elements
of a slice of pages and gives back these alone. No step shuffles, and `html`
goes no further than the first select.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from html import unescape
from itertools import chain
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotledger.functions.binding import let
from lotledger.functions.text import SPACE, null_if_empty, strip_ws
from lotledger.functions.urls import absolute

NODES = (
    "array<struct<id:int,parent:int,last:int,nth:int,tag:string,"
    "classes:array<string>,attrs:map<string,string>,texts:array<string>>>"
)

# HTML elements without an end tag, and those an opening sibling closes.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "p": {"p"},
    "option": {"option"},
}
_NAME = rf"[a-zA-Z][^{SPACE}/>]*+"
_IN_TAG = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+(?=>)|[^>]*+"""
# An end tag; an element with raw text, whole; a start tag, with text and end tag where nothing else stands between; what is no element.
_TAG = re.compile(
    rf"<(?:/({_NAME})(?:>|[^>]*+>)"
    rf"|([sS](?:(?ai:cript)|((?ai:tyle))))(?=[{SPACE}/>])(?:>|({_IN_TAG})>)"
    r"((?:[^<]++|<(?!/(?(3)(?i:style)|(?i:script))\s*>))*+)(?:<[^>]*+>)?+"
    rf"|({_NAME})(?:>|({_IN_TAG})>)(?:([^<]*+)</\6>)?+"
    r"|!--.*?(?:-->|\Z)"
    r"|[!?][^>]*+>)",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


class Elements:
    """Elements of a slice of pages as flat arrays, in document order; an element's id is its place there.

    `page` is the number of its page, `last` the last element inside it, and the
    parent of a topmost one is negative. Texts and attribute texts stand in
    document order with their owners; attributes are read when they are asked for.

    `within` and `of` are one id per page, -1 for none, as `first` gives them;
    other ids are ascending.
    """

    def __init__(self, pages: Sequence[str | None]) -> None:
        self.tags: list[str] = []
        by_tag: defaultdict[str, list[int]] = defaultdict(list)
        parents, last, owners, texts, attr_owners, attrs = [], [], [], [], [], []
        ends = [0]
        for html in pages:
            self._read(html or "", by_tag, parents, last, owners, texts, attr_owners, attrs)
            ends.append(len(parents))
        self.ends = np.asarray(ends)
        self.page = np.repeat(np.arange(len(pages)), np.diff(self.ends))
        self.parent = np.asarray(parents, np.int64)
        self.parent = np.where(self.parent < 0, -1 - self.page, self.parent)
        self.last = np.asarray(last, np.int64)
        self._by_tag = {tag: np.asarray(ids, np.int64) for tag, ids in by_tag.items()}
        self.owner = np.asarray(owners, np.int64)
        self.texts = pa.array(texts, pa.string())
        self._first_text = np.full(len(parents), -1)
        self._first_text[self.owner[::-1]] = np.arange(len(owners))[::-1]
        self.attr_owner = np.asarray(attr_owners, np.int64)
        self.attrs = pa.array(attrs, pa.string()).dictionary_encode()

    def _read(self, html, by_tag, parents, last, owners, texts, attr_owners, attrs) -> None:
        tags, count = self.tags, len(parents)
        names: list[str] = []
        name, here = None, -1
        parts = _TAG.split(html)
        part = iter(parts)
        for text, ended, raw, _, raw_attrs, raw_text, started, with_attrs, own in zip(*[part] * 9):
            if text and name is not None:
                owners.append(here)
                texts.append(unescape(text) if "&" in text else text)
            if started:
                tag = started.lower()
                if tag in _CLOSES:
                    closed = _CLOSES[tag]
                    while name in closed:
                        last[here] = count - 1
                        here = parents[here]
                        names.pop()
                        name = names[-1] if names else None
                tags.append(tag)
                by_tag[tag].append(count)
                parents.append(here)
                last.append(count)
                if with_attrs:
                    attr_owners.append(count)
                    attrs.append(with_attrs)
                if own is None:
                    if tag not in _VOID:
                        names.append(tag)
                        name, here = tag, count
                elif own:
                    owner = count if tag not in _VOID else here
                    if owner >= 0:
                        owners.append(owner)
                        texts.append(unescape(own) if "&" in own else own)
                count += 1
            elif ended:
                tag = ended.lower()
                if tag != name:
                    if tag not in names:
                        continue
                    while names[-1] != tag:
                        last[here] = count - 1
                        here = parents[here]
                        names.pop()
                last[here] = count - 1
                here = parents[here]
                names.pop()
                name = names[-1] if names else None
            elif raw:
                tag = raw.lower()
                tags.append(tag)
                by_tag[tag].append(count)
                parents.append(here)
                last.append(count)
                if raw_attrs:
                    attr_owners.append(count)
                    attrs.append(raw_attrs)
                owners.append(count)
                texts.append(raw_text)
                count += 1
        if parts[-1] and name is not None:
            owners.append(here)
            texts.append(unescape(parts[-1]) if "&" in parts[-1] else parts[-1])
        while here >= 0:
            last[here] = count - 1
            here = parents[here]

    def ids(self, tag: str, within: np.ndarray | None = None) -> np.ndarray:
        """Elements of that name, a container in question among them."""
        found = self._by_tag.get(tag, np.empty(0, np.int64))
        if within is None or not len(found):
            return found
        top = within[self.page[found]]
        return found[(top >= 0) & (found >= top) & (found <= self.last[top])]

    def children(self, tag: str, of: np.ndarray) -> np.ndarray:
        found = self.ids(tag, of)
        return found[self.parent[found] == of[self.page[found]]]

    def first(self, ids: np.ndarray, nth: int = 1) -> np.ndarray:
        """The first id of every page, or its nth."""
        if nth > 1:
            pages = self.page[ids]
            ids = ids[np.arange(len(ids)) - np.searchsorted(pages, pages) == nth - 1]
        found = np.full(len(self.ends) - 1, -1)
        found[self.page[ids[::-1]]] = ids[::-1]
        return found

    def with_class(self, ids: np.ndarray, name: str) -> np.ndarray:
        has = [
            (name in text or "&" in text) and name in _attributes(text).get("class", "").split()
            for text in self.attrs.dictionary.to_pylist()
        ]
        owners = self.attr_owner[np.asarray(has, bool)[self.attrs.indices.to_numpy()]]
        return np.intersect1d(ids, owners, assume_unique=True)

    def with_text(self, ids: np.ndarray, chosen: pa.Array | None = None) -> np.ndarray:
        """Those that have an own text, or one of the chosen (a mask over `texts`)."""
        if chosen is None:
            return ids[self._first_text[ids] >= 0]
        return np.intersect1d(ids, self.owner[chosen.to_numpy(zero_copy_only=False)])

    def text(self, ids: np.ndarray) -> pa.Array:
        """First own text of each, null for -1 and where there is none."""
        at = np.full(len(ids), -1)
        at[ids >= 0] = self._first_text[ids[ids >= 0]]
        return self.texts.take(pa.array(at, mask=at < 0))

    def first_attr(self, ids: np.ndarray, name: str) -> pa.Array:
        """Per page, the first value of an attribute among the elements."""
        at = np.flatnonzero(np.isin(self.attr_owner, ids))
        codes = self.attrs.indices.to_numpy()[at]
        values = {code: _attributes(self.attrs.dictionary[code].as_py()).get(name) for code in np.unique(codes).tolist()}
        found: list[str | None] = [None] * (len(self.ends) - 1)
        for page, code in zip(self.page[self.attr_owner[at]].tolist(), codes.tolist()):
            if found[page] is None:
                found[page] = values[code]
        return pa.array(found, pa.string())

    def after(self, marks: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """For each of the marks its first following sibling among the ids, -1 without one."""
        order = np.lexsort((ids, self.parent[ids]))
        # Dense numbers of parents, so that one number tells parent and place.
        parents, dense = np.unique(np.concatenate([self.parent[ids[order]], self.parent[marks]]), return_inverse=True)
        step = len(self.parent) + 1
        keys = dense[: len(ids)] * step + ids[order]
        at = np.searchsorted(keys, dense[len(ids) :] * step + marks)
        found = np.append(ids[order], -1)[at]
        return np.where((found >= 0) & (self.parent[found] == self.parent[marks]), found, -1)

    def lists(self, chosen: np.ndarray) -> pa.Array:
        """The chosen texts (their places in `texts`), one list per page."""
        sizes = np.bincount(self.page[self.owner[chosen]], minlength=len(self.ends) - 1)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.texts.take(pa.array(chosen)))

    def to_arrow(self) -> pa.Array:
        count = len(self.tags)

        def ints(values) -> pa.Array:
            return pa.array(np.asarray(values, np.int32))

        def strings(values: list[str]) -> pa.Array:
            return pa.array(values, pa.string())

        def ends(sizes) -> pa.Array:
            return ints(np.concatenate(([0], np.cumsum(sizes))))

        parsed = [_attributes(text) for text in self.attrs.dictionary.to_pylist()]
        attrs: list[dict[str, str]] = [{}] * count
        for at, code in zip(self.attr_owner.tolist(), self.attrs.indices.to_pylist()):
            attrs[at] = parsed[code]
        classes = [a["class"].split() if "class" in a else () for a in attrs]
        # Texts come in page order; group them by their element.
        texts = self.texts.take(pa.array(np.argsort(self.owner, kind="stable")))
        starts = self.ends[self.page]
        seen: dict[tuple[int, str], int] = {}
        nth = []
        for key in zip(self.parent.tolist(), self.tags):
            seen[key] = now = seen.get(key, 0) + 1
            nth.append(now)
        columns = {
            "id": ints(np.arange(count) - starts),
            "parent": ints(np.where(self.parent < 0, -1, self.parent - starts)),
            "last": ints(self.last - starts),
            "nth": ints(nth),
            "tag": strings(self.tags),
            "classes": pa.ListArray.from_arrays(ends([len(c) for c in classes]), strings([*chain.from_iterable(classes)])),
            "attrs": pa.MapArray.from_arrays(
                ends([len(a) for a in attrs]),
                strings([*chain.from_iterable(attrs)]),
                strings([*chain.from_iterable(a.values() for a in attrs)]),
            ),
            "texts": pa.ListArray.from_arrays(ends(np.bincount(self.owner, minlength=count)), texts),
        }
        elements = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
        return pa.ListArray.from_arrays(ints(self.ends), elements)


def _with_elements(pages: DataFrame, html: str, name: str, kind: str, read: Callable[[Elements], pa.Array]) -> DataFrame:
    """Replace the page text by what `read` makes of the elements; other columns pass through."""
    names = [f.name for f in pages.schema.fields if f.name != html]
    schema = ", ".join([f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names] + [f"`{name}` {kind}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Small slices bound the memory that a batch of large pages takes.
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = read(Elements(part.column(part.schema.get_field_index(html)).to_pylist()))
                columns = [part.column(part.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, found], names=[*names, name])

    return pages.mapInArrow(run, schema)


def page_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the page text by the array of its elements; other columns pass through."""
    return _with_elements(pages, html, "nodes", NODES, Elements.to_arrow)


def page_fields(
    pages: DataFrame,
    kinds: Mapping[str, str],
    read: Callable[[Elements], Sequence[pa.Array]],
    html: str = "html",
    name: str = "found",
) -> DataFrame:
    """Replace the page text by a struct of fields (`kinds`: name to type); other columns pass through.

    For pages of which a few values are wanted: the elements stay in the task,
    and only the columns that `read` finds for a slice of pages go back to the JVM.
    """
    kind = f"struct<{', '.join(f'`{field}`: {kind}' for field, kind in kinds.items())}>"
    return _with_elements(pages, html, name, kind, lambda e: pa.StructArray.from_arrays(read(e), names=list(kinds)))


Cond = Callable[[Column], Column]


def has_class(n: Column, *classes: str) -> Column:
    """All of the classes are set on the element."""
    return reduce(and_, [F.array_contains(n["classes"], c) for c in classes])


def has_attr(n: Column, name: str, value: str) -> Column:
    return F.coalesce(n["attrs"][name] == value, F.lit(False))


def has_text(n: Column, text: str) -> Column:
    return F.array_contains(n["texts"], text)


def text_nodes(nodes: Column, cond: Cond) -> Column:
    """Own texts of all matching elements, in page order."""
    return F.flatten(F.transform(F.filter(nodes, cond), lambda n: n["texts"]))


def first_text(nodes: Column, cond: Cond, nth: int = 0) -> Column:
    return F.get(text_nodes(nodes, cond), F.lit(nth))


def first_attr(nodes: Column, cond: Cond, name: str) -> Column:
    values = F.transform(F.filter(nodes, cond), lambda n: n["attrs"][name])
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def subtrees(nodes: Column, cond: Cond) -> Column:
    """One array of elements (the container first) per matching container.

    `nodes` may itself be a cut subtree, whose ids do not start at 0.
    """

    def cut(all_: Column) -> Column:
        # Ids are dense, so a container is a slice.
        return F.transform(
            F.filter(all_, cond),
            lambda c: F.slice(all_, c["id"] - F.get(all_, F.lit(0))["id"] + 1, c["last"] - c["id"] + 1),
        )

    return let(nodes, cut)


def subtree(nodes: Column, cond: Cond) -> Column:
    """Elements of the first matching container; null if there is none."""
    return F.get(subtrees(nodes, cond), F.lit(0))


def children(nodes: Column, tag: str, nth: int | None = None) -> Cond:
    """Condition: a child of the first element of `nodes` (bind it with `let`), by name and position."""
    top = F.get(nodes, F.lit(0))["id"]

    def cond(n: Column) -> Column:
        found = (n["tag"] == tag) & (n["parent"] == top)
        return found if nth is None else found & (n["nth"] == nth)

    return cond


def sibling_after(nodes: Column, mark: Column, tag: str) -> Column:
    """First following sibling of that name (bind `nodes` and `mark` with `let`)."""
    return F.get(
        F.filter(nodes, lambda n: (n["tag"] == tag) & (n["parent"] == mark["parent"]) & (n["id"] > mark["id"])),
        F.lit(0),
    )


def page_rows(pages: DataFrame, container: Cond, link: Callable[[Column], Column]) -> DataFrame:
    """One row per listing container; a container without a link gives no row.

    `pages` has `nodes`; the result has `item` (the container's elements) and
    `link` in its place.
    """
    rest = [c for c in pages.columns if c != "nodes"]
    items = pages.select(*rest, F.explode(subtrees(F.col("nodes"), container)).alias("item"))
    return items.withColumn("link", link(F.col("item"))).where(F.col("link").isNotNull())


def label_pairs(nodes: Column, key: Callable[[Column], Column], label: str = "dt", value: str = "dd") -> Column:
    """map<label, value text>: first `value` sibling that follows the label element.

    `key` names the label (its text, or an attribute). Of several labels with
    one name the first counts.
    """

    def pairs(all_: Column) -> Column:
        return F.transform(
            F.filter(all_, lambda n: (n["tag"] == label) & key(n).isNotNull()),
            lambda d: F.struct(
                key(d).alias("key"), F.get(sibling_after(all_, d, value)["texts"], F.lit(0)).alias("value")
            ),
        )

    return let(let(nodes, pairs), _first_per_label)


def _first_per_label(pairs: Column) -> Column:
    def first(keys: Column) -> Column:
        return F.filter(pairs, lambda p, i: F.array_position(keys, p["key"]) == i + 1)

    return F.map_from_entries(let(F.transform(pairs, lambda p: p["key"]), first))


def label_map(pages: DataFrame, key: Callable[[Column], Column] | None = None) -> DataFrame:
    """Pages with `nodes` to pages with `labels`, by label text unless told otherwise."""
    key = key or (lambda n: F.get(n["texts"], F.lit(0)))
    rest = [c for c in pages.columns if c != "nodes"]
    return pages.select(*rest, label_pairs(F.col("nodes"), key).alias("labels"))


def spec_select(df: DataFrame, source: str, spec: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Project every field of a spec out of one column, stripped, null if absent."""
    rest = [c for c in df.columns if c != source and c not in spec]
    return df.select(*rest, *[strip_ws(path(F.col(source))).alias(name) for name, path in spec.items()])


def tag_text(html: Column, tag: str) -> Column:
    """Text of the first flat element of that name."""
    return null_if_empty(F.regexp_extract(html, rf"<{tag}(?:\s[^>]*)?>([^<]*)", 1))


def visible(html: Column) -> Column:
    """Page text without scripts, styles and comments, whose text may look like markup."""
    return F.regexp_replace(html, r"(?s)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "")


def blocks(html: Column, tag: str) -> Column:
    """Inner texts of all elements of that name which do not nest in themselves."""
    return F.regexp_extract_all(visible(html), F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(visible(html), F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))


def links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(page, pos, link): every link of a page, resolved against its URL."""
    found = pages.select(key, "url", F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))
    return found.select(key, "pos", absolute(F.col("url"), F.col("href")).alias("link"))

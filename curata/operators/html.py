"""HTML manuals to markdown: headings, paragraphs, lists, quotes, code, tables and inline marks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "section", "article", "main", "body", "html", "header", "footer", "aside", "ul", "ol", "li", "table", "tr", "td", "th", "thead", "tbody", "tfoot", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "dl", "dt", "dd", "form", "nav", "figure", "address", "center"}
IMPLIED_END = {"li": {"li"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
SKIPPED = {"script", "style", "nav", "head"}


class Node:
    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def has_class(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else "" if c.tag in SKIPPED else c.text() for c in self.children)


    def texts(self) -> Iterator[str]:
        """The text nodes below, in order."""
        for c in self.children:
            if isinstance(c, str):
                yield c
            elif c.tag not in SKIPPED:
                yield from c.texts()

    def words(self, sep: str = " ") -> str:
        """The stripped text nodes that aren't blank, joined."""
        return sep.join(filter(None, map(str.strip, self.texts())))

    def below(self, *tags: str) -> Iterator[Node]:
        """The elements of these tags below, at any depth."""
        for c in self.children:
            if isinstance(c, Node):
                if c.tag in tags:
                    yield c
                yield from c.below(*tags)


class Tree(HTMLParser):
    """Builds a tree from tag soup: ends that HTML implies, end tags without a start ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def _up_to(self, tags: set[str], stop: set[str]) -> None:
        n = self.at
        while n.parent is not None and n.tag not in stop:
            if n.tag in tags:
                self.at = n.parent
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._up_to({"p"}, BLOCKS - {"p"})
        if tag in IMPLIED_END:
            self._up_to(IMPLIED_END[tag], {"ul", "ol", "table", "dl", "select"} | ({"tr"} if tag in ("td", "th") else set()))
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None:
            if n.tag == tag:
                self.at = n.parent
                return
            if n.tag in BLOCKS and tag not in BLOCKS:
                return
            n = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def one_line(text: str) -> str:
    return " ".join(text.replace("\xa0", " ").split())


def tight(text: str) -> str:
    """One line without spaces before punctuation or inside brackets."""
    text = re.sub(r"\s+([,.;:!?])", r"\1", one_line(text))
    text = re.sub(r"([(\[]) +", r"\1", text)
    return re.sub(r" +([)\]])", r"\1", text).strip()


def inline(node: Node | str) -> str:
    if isinstance(node, str):
        return node.replace("\xa0", " ")
    inner = lambda: "".join(map(inline, node.children))
    match node.tag:
        case "br":
            return "\n"
        case "strong" | "b":
            return f" **{tight(node.words())}** "
        case "em" | "i":
            return f" *{tight(node.words())}* "
        case "code" if node.parent is None or node.parent.tag != "pre":
            return f" `{tight(node.words())}` "
        case "a":
            text, href = tight(inner()), node.attrs.get("href")
            return f"[{text}]({href})" if text and href else text
        case "img":
            return tight(node.attrs.get("alt", ""))
        case tag if tag in SKIPPED:
            return ""
    return inner()


def paragraph(raw: str) -> str:
    """Lines cleaned; blank ones between others kept, one at a time."""
    lines = [tight(x) for x in raw.replace("\r\n", "\n").split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def table(node: Node) -> str:
    rows = [[one_line(cell.words()) for cell in row.below("td", "th")] for row in node.below("tr")]
    rows = [r for r in rows if r]
    if not rows:
        return ""
    width = max(map(len, rows))
    padded = [r + [""] * (width - len(r)) for r in rows]
    lines = ["| " + " | ".join(r) + " |" for r in (padded[0], ["---"] * width, *padded[1:])]
    caption = one_line(node.attrs.get("summary", ""))
    return (f"Tabelle: {caption}\n\n" if caption else "") + "\n".join(lines)


def items(node: Node, depth: int = 0) -> list[str]:
    """A list's lines; nested lists are indented by two."""
    out: list[str] = []
    number = int(node.attrs["start"]) if node.attrs.get("start", "").isdigit() else 1
    for li in node.children:
        if not isinstance(li, Node) or li.tag != "li":
            continue
        mark = f"{number}. " if node.tag == "ol" else "- "
        number += 1
        parts = [p for p in blocks(li, depth + 1) if p]
        lines = "\n".join(parts).split("\n") if parts else [""]
        pad = "  " * depth
        out.append(pad + mark + lines[0])
        out += [x if x.startswith("  " * (depth + 1)) else pad + "  " + x for x in lines[1:]]
    return out


def blocks(node: Node, depth: int = 0) -> list[str]:
    """Markdown blocks of an element's children; inline content between blocks is a paragraph."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if text := paragraph("".join(held)):
            out.append(text)
        held.clear()

    for c in node.children:
        if isinstance(c, str) or c.tag not in BLOCKS:
            if not (isinstance(c, str) and c.strip() in (">", "Â")) and not (isinstance(c, Node) and c.tag in SKIPPED):
                held.append(inline(c))
            continue
        flush()
        if c.has_class("src") and c.tag == "div":  # a source marker is a paragraph of its words
            out += [t] if (t := paragraph(c.words())) else []
            continue
        if c.tag in SKIPPED or c.tag == "hr" or c.has_class("toc") or c.has_class("meta"):
            continue
        match c.tag:
            case "pre":
                out += ["```\n" + t + "\n```"] if (t := "\n".join(c.texts()).strip("\n")) else []
            case "blockquote":
                out.append("\n".join(f"> {t}" for x in c.words("\n").split("\n") if (t := one_line(x))))
            case "ul" | "ol":
                out.append("\n".join(items(c, depth)))
            case "table":
                out.append(table(c))
            case "p":
                out += [t] if (t := paragraph("".join(map(inline, c.children)))) else []
            case h if re.fullmatch("h[1-6]", h):
                title = one_line(c.words())
                if title and not (h == "h1" and out and re.fullmatch("#{2,6} " + re.escape(title), out[-1])):
                    out.append("#" * int(h[1]) + " " + title)
            case _:
                out += blocks(c, depth)
    flush()
    return [b for b in out if b.strip()]


# Fixed value: a heading with prose behind its end.
PROSE = re.compile(r"^(#{1,6}\s+.+?[.!?:])[ \t]+(\S.*)$")


def repaired(text: str) -> str:
    """Headings and source markers on lines of their own, apart from prose that was merged into them."""
    lines: list[str] = []
    fenced = False
    for line in text.split("\n"):
        fenced ^= line.startswith("```")
        for part in [line] if fenced else re.split(r"\s+(?=#{1,6}\s\S)|\s+(?=Quelle:\s)", line) if line.startswith(("#", "Quelle:")) else [line]:
            m = PROSE.match(part) if not fenced else None
            for x in [m[1], m[2]] if m and len(m[2].split()) >= 3 else [part]:
                alone = not fenced and x.startswith(("#", "Quelle:"))
                if alone and lines and lines[-1]:
                    lines.append("")
                lines.append(x)
                if alone:
                    lines.append("")
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x.rstrip() for x in lines)).strip() + "\n"


def to_markdown(html: str) -> tuple[str, str]:
    """The title (first ``h1``) and the markdown of a page."""
    tree = Tree()
    tree.feed(html)
    tree.close()

    def find(n: Node) -> Node | None:
        for c in n.children:
            if isinstance(c, Node) and (hit := c if c.tag == "h1" else find(c)):
                return hit
        return None

    heading = find(tree.root)
    body = "\n\n".join(blocks(tree.root))
    return heading.words() if heading else "", repaired(body) if body else ""


def normalize_pages(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(``key``, ``title``, ``markdown``, ``checksum``) of each page; a null page is empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [to_markdown(h) for h in f["html"]]
            yield pd.DataFrame({"key": f["key"], "title": [m[0] for m in made], "markdown": [m[1] for m in made]})

    source = pages.select(F.col(key).alias("key"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    kind = pages.schema[key].dataType.simpleString()
    return source.mapInPandas(run, f"key {kind}, title string, markdown string").select(F.col("key").alias(key), "title", "markdown", F.sha2("markdown", 256).alias("checksum"))


def normalize_files(files: DataFrame, version: str) -> DataFrame:
    """Raw files (``path``, ``text``) as markdown with their metadata: HTML is converted, other text stays; both end with one line feed."""
    is_html = F.lower("path").rlike(r"\.html?$")
    made = normalize_pages(files.where(is_html), "path", "text").select("path", "markdown")
    plain = files.where(~is_html).select("path", F.coalesce("text", F.lit("")).alias("markdown"))
    whole = made.unionByName(plain).withColumn("markdown", F.concat(F.regexp_replace("markdown", r"^\s+|\s+$", ""), F.lit("\n")))
    target = F.regexp_replace("path", r"\.[^./]*$", ".md")
    return whole.select(F.col("path").alias("normalized_from"), target.alias("normalized_file"), "markdown", F.sha2("markdown", 256).alias("normalized_checksum"), F.lit(version).alias("transform_pipeline_version"))


def manual_metadata(pages: DataFrame, prefix: str, product: str, language: str, collection: str, root: str, version: str) -> DataFrame:
    """Metadata of normalized manuals from their raw pages (``path``, ``text``, ``modified``): ids from file names, checksums, dates and provenance."""
    stem = F.regexp_replace(F.regexp_extract("path", "[^/]*$", 0), r"\.[^.]*$", "")
    slug = F.btrim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(stem)), f"^{re.escape(prefix)}", ""), "[^a-z0-9]+", "_"), F.lit("_"))
    checksum = F.sha2(F.coalesce("text", F.lit("")), 256)
    return pages.select(
        F.concat(F.lit(prefix), slug).alias("doc_id"), F.lit(product).alias("product"), F.lit(language).alias("language"), F.lit(collection).alias("version"), F.lit("html").alias("source_type"), F.col("path").alias("source_file"),
        F.regexp_replace("path", "/[^/]*$", "").alias("source_path"), F.concat(F.lit(root.rstrip("/") + "/"), slug, F.lit("/index.md")).alias("normalized_path"), checksum.alias("checksum"), F.date_format("modified", "yyyy-MM-dd").alias("import_date"),
        F.lit("raw_html_to_normalized_markdown").alias("conversion_stage"), F.lit(version).alias("transform_pipeline_version"), F.struct(F.lit(collection).alias("raw_collection_id"), checksum.alias("source_checksum")).alias("provenance"),
    )

"""Shredding: XML filings to header rows and element rows, the one place where filings are parsed.

The helper reads each document as events, piece by piece, and gives every element its path, its place in
document order and its enclosing elements. It holds the open elements and the header, never the document's
tree: a first reading checks that the document is well-formed and finds its header, a second one gives the
elements. Everything after that is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUSES = ("ok", "malformed", "no_header", "no_data")
HEADERS = "path string, status string, return_version string, ein string, tax_period string, org_name string, form_type string"
LEGACY = "legacy_ein string, legacy_period string, legacy_name string"
ELEMENTS = "path string, return_version string, status string, section string, xpath string, doc_ord long, text string, anc array<struct<xpath:string,ord:long>>, in_root_ns boolean"
#: Elements of one output batch.
BATCH = 20_000
WRAPPERS = ("Return", "ReturnData", "ReturnHeader")


#: A filing of more bytes comes to the helper in pieces of so many, twice; and bytes parsed at a time.
PIECE, STEP = 1 << 20, 1 << 16


class Malformed(ValueError):
    """Not well-formed, or with entities of its own (expansion bombs)."""


def refuse(*_: object) -> None:
    raise Malformed


def split_name(name: str) -> tuple[str, str]:
    """(namespace, name) as the parser joins them."""
    space, mark, own = name.partition("}")
    return (space, own) if mark else ("", name)


def run_parser(parser: expat.XMLParserType, pieces: Iterable[bytes]) -> Iterator[None]:
    """Feed all pieces, a step at a time; raises Malformed."""
    try:
        for piece in pieces:
            if len(piece) <= STEP:
                parser.Parse(piece, False)
                yield
                continue
            view = memoryview(piece)
            for at in range(0, len(view), STEP):
                parser.Parse(view[at : at + STEP], False)
                yield
        parser.Parse(b"", True)
        yield
    except (expat.ExpatError, ValueError, LookupError) as e:
        raise Malformed from e


def new_parser(decoded: bool) -> expat.XMLParserType:
    """``decoded``: the bytes are UTF-8, whatever the document declares."""
    parser = expat.ParserCreate("utf-8" if decoded else None, "}")
    parser.EntityDeclHandler = parser.SkippedEntityHandler = refuse
    parser.buffer_text = True
    return parser


class Reading:
    """One reading of a document: the header's small tree, the root's attributes, whether there is a data element, and rows.

    With ``walks`` the content of the data element (with ``whole``: of the root, and no header) becomes ``rows`` of
    (section, xpath, doc_ord, text, anc, in_root_ns): for the time of that element the parser has the walk's handlers.
    As soon as header and data are found and done, the rest is only checked.
    """

    def __init__(self, decoded: bool, walks: bool, wanted: frozenset[str] | None = None, whole: bool = False):
        self.space, self.version, self.header, self.has_data, self.whole = "", "", None, False, whole
        self.depth, self.builder, self.rows = 0, None, []
        self.walks, self.wanted = walks, wanted
        self.parser = new_parser(decoded)
        self.parser.StartElementHandler, self.parser.EndElementHandler = self.start, self.end

    def start(self, name: str, attributes: dict[str, str]) -> None:
        self.depth += 1
        if self.builder is not None:
            self.builder.start("{" + name if "}" in name else name, {})
            return
        if self.depth > 2:
            return
        space, own = split_name(name)
        if self.depth == 1:
            self.space, self.version = space, attributes.get("returnVersion", "")
            if self.whole:
                self.walk("root_fallback")
        elif space == self.space:
            if own == "ReturnData" and not self.has_data:
                self.has_data = True
                if self.walks:
                    self.walk("data")
                elif self.header is not None:
                    self.parser.StartElementHandler = self.parser.EndElementHandler = None
            elif own == "ReturnHeader" and self.header is None and not self.whole:
                self.builder = ElementTree.TreeBuilder()
                self.parser.CharacterDataHandler = self.builder.data
                # text ends at a comment, which is an element without a name here
                self.parser.CommentHandler = self.parser.ProcessingInstructionHandler = self.mark
                self.builder.start("{" + name if "}" in name else name, {})

    def mark(self, *_: str) -> None:
        self.builder.start("!", {})
        self.builder.end("!")

    def end(self, name: str) -> None:
        self.depth -= 1
        if self.builder is not None:
            self.builder.end("{" + name if "}" in name else name)
            if self.depth == 1:
                self.header, self.builder = self.builder.close(), None
                self.back()

    def back(self) -> None:
        """The handlers after the header or the walk."""
        done = self.whole or (self.has_data and self.header is not None)
        parser = self.parser
        parser.CharacterDataHandler = parser.CommentHandler = parser.ProcessingInstructionHandler = None
        parser.StartElementHandler, parser.EndElementHandler = (None, None) if done else (self.start, self.end)

    def walk(self, section: str) -> None:
        """Handlers for what is in the element that has just begun: a stack of the open elements, and the one whose text goes on."""
        rows, space, wanted = self.rows, self.space, self.wanted
        names: dict[str, tuple[str, bool]] = {}
        stack: list[tuple[str, tuple, bool]] = [("", (), True)]
        texts: list[str] = []
        number = 0
        last: tuple | None = None

        def close() -> None:
            nonlocal last
            xpath, at, anc, inside = last
            rows.append((section, xpath, at, "".join(texts).strip() if texts else "", anc, inside))
            texts.clear()
            last = None

        def start(name: str, _: dict) -> None:
            nonlocal number, last
            if last is not None:
                close()
            known = names.get(name)
            if known is None:
                own_space, own = split_name(name)
                known = names[name] = (own, own_space == space)
            own, same = known
            above, anc, inside = stack[-1]
            inside = inside and same
            if own in WRAPPERS:  # the path begins anew below a wrapper
                stack.append(("", (), inside))
            else:
                xpath = f"{above}/{own}"
                stack.append((xpath, (*anc, (xpath, number)), inside))
                if wanted is None or xpath in wanted:
                    last = (xpath, number, anc, inside)
            number += 1

        def end(_: str) -> None:
            if last is not None:
                close()
            stack.pop()
            if not stack:  # the walked element itself
                self.depth -= 1
                self.back()

        def other(*_: str) -> None:
            if last is not None:
                close()

        def text(value: str) -> None:
            if last is not None:
                texts.append(value)

        parser = self.parser
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
        parser.CommentHandler = parser.ProcessingInstructionHandler = other


class Filing:
    """A document whose pieces can be read twice; None instead of pieces: no document. False if it is malformed.

    A ``small`` one is read once and its rows are held, which its size bounds; of a larger one the first reading tells
    whether it is well-formed, and a second one gives its elements as they come. ``walks``: whether they are wanted at all.
    """

    def __init__(self, pieces: Callable[[], Iterable[bytes]] | None, decoded: bool, wanted: frozenset[str] | None = None, small: bool = False, walks: bool = True):
        self.pieces, self.decoded, self.wanted, self.outline, self.rows = pieces, decoded, wanted, None, None
        if pieces is None:
            return
        try:
            found = Reading(decoded, small and walks, wanted)
            for _ in run_parser(found.parser, pieces()):
                pass
            self.outline = found
            if small and walks:
                self.rows = found.rows if found.has_data else list(self.streamed())
        except Malformed:
            self.outline = None

    def __bool__(self) -> bool:
        return self.outline is not None

    def elements(self) -> Iterable[tuple]:
        """(section, xpath, doc_ord, text, anc, in_root_ns) of the elements below the data, else below the root.

        Numbers count all elements of the walk, whatever is wanted. An element is given when its text is known: at
        the first thing in it, or at its end, and so in document order.
        """
        return self.streamed() if self.rows is None else self.rows

    def streamed(self) -> Iterator[tuple]:
        reading = Reading(self.decoded, True, self.wanted, whole=not self.outline.has_data)
        for _ in run_parser(reading.parser, self.pieces()):
            if reading.rows:
                yield from reading.rows
                reading.rows.clear()


def pieces_of(filings: DataFrame, path_col: str, content_col: str, readings: int = 2) -> DataFrame:
    """(path, readings, count, decoded, piece): a small filing is one row, a larger one its pieces in order, ``readings`` times.

    A filing's rows follow each other in one partition; nothing is shuffled.
    """
    decoded = filings.schema[content_col].dataType.simpleString() == "string"
    rows = filings.select(F.col(path_col).cast("string").alias("path"), F.col(content_col).cast("binary").alias("content"))
    rows = rows.withColumn("count", F.greatest(F.ceil(F.octet_length("content") / PIECE).cast("int"), F.lit(1)))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.when(F.col("count") > 1, readings * F.col("count") - 1).otherwise(0))))
    piece = F.when(F.col("count") > 1, F.substring("content", (F.pmod("k", "count") * PIECE + 1).cast("int"), F.lit(PIECE))).otherwise(F.col("content"))
    return rows.select("path", F.lit(readings).alias("readings"), "count", F.lit(decoded).alias("decoded"), piece.alias("piece"))


def read_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bool, bytes | None]]:
    for batch in batches:
        heads = [batch[c].to_pylist() for c in ("path", "readings", "count", "decoded")]
        for *head, value in zip(*heads, batch["piece"], strict=True):
            yield *head, value.as_buffer() if value.is_valid else None


class Pieces:
    """The two readings of a large filing, whose first row is taken and whose others are still to come."""

    def __init__(self, rows: Iterator[tuple], first: bytes, half: int, decoded: bool):
        self.rows, self.first, self.half, self.decoded, self.taken = rows, first, half, decoded, 0

    def upto(self, end: int) -> Iterator[bytes]:
        while self.taken < end:
            piece = next(self.rows)[-1] if self.taken else self.first
            begins, self.taken = self.taken % self.half == 0, self.taken + 1
            yield stripped(piece) if begins and self.decoded else piece

    def reading(self) -> Iterator[bytes]:
        return self.upto(self.half if self.taken < self.half else 2 * self.half)

    def skip(self, end: int) -> None:
        for _ in self.upto(end):
            pass


def filings_in(batches: Iterable[pa.RecordBatch], wanted: frozenset[str] | None = None, walks: bool = True) -> Iterator[tuple[str, Filing]]:
    """(path, filing) out of rows of pieces. A filing's elements must be taken before the next filing is."""
    rows = read_pieces(batches)
    for path, readings, count, decoded, piece in rows:
        if count == 1:
            whole = piece if piece is None or not decoded else stripped(piece)
            yield path, Filing(None if whole is None else lambda whole=whole: (whole,), decoded, wanted, small=True, walks=walks)
            continue
        held = Pieces(rows, piece, count, decoded)
        filing = Filing(held.reading, decoded, wanted, walks=walks)
        held.skip(count)  # what a malformed one left
        yield path, filing
        held.skip(readings * count)


def stripped(piece: bytes) -> bytes:
    """Decoded text may begin with white space even before its declaration."""
    return bytes(piece).lstrip()


def own_text(element: ElementTree.Element | None) -> str:
    """Text before the first child, stripped."""
    return (element.text or "").strip() if element is not None else ""


def header_of(filing: Filing) -> dict[str, str]:
    """Header values by both rules: the extraction's and, with older names, the audit's."""
    out = dict.fromkeys(("return_version", "ein", "tax_period", "org_name", "form_type", "legacy_ein", "legacy_period", "legacy_name"), "")
    if not filing:
        return out | {"status": "malformed"}
    outline = filing.outline
    space, header = "{%s}" % outline.space if outline.space else "", outline.header
    out["return_version"] = outline.version
    out["status"] = "no_header" if header is None else "ok" if outline.has_data else "no_data"
    if header is None:
        return out
    out["ein"] = own_text(header.find(f".//{space}Filer/{space}EIN"))
    out["tax_period"] = own_text(header.find(f"{space}TaxPeriodEndDt"))
    out["org_name"] = own_text(header.find(f".//{space}Filer/{space}BusinessName/{space}BusinessNameLine1Txt"))
    out["form_type"] = own_text(header.find(f"{space}ReturnTypeCd"))
    for old in ("TaxPeriodEndDt", "TaxPeriodEndDate", "TaxYr", "TaxYear"):  # the first that has text
        found = header.find(space + old)
        if found is not None and found.text:
            out["legacy_period"] = found.text.strip()
            break
    direct = header.find(f"{space}Filer")
    if direct is not None:
        out["legacy_ein"] = own_text(direct.find(f"{space}EIN"))
        names = direct.find(f"{space}BusinessName")  # the first that exists
        names = direct.find(f"{space}Name") if names is None else names
        if names is not None:
            line = names.find(f"{space}BusinessNameLine1Txt")
            out["legacy_name"] = own_text(names.find(f"{space}BusinessNameLine1") if line is None else line)
    return out


def headers(filings: DataFrame, *, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """SRC-3, SRC-4, SRC-7. One row per filing: status, version and header values.

    ``status``: ok, malformed (also null content), no_header, no_data. Values that are missing are "".
    ``legacy_*`` follow the audit's rule with older element names.
    """
    names = [x.split()[0] for x in f"{HEADERS}, {LEGACY}".split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ({"path": path} | header_of(filing) for path, filing in filings_in(batches, walks=False))
        while rows := list(islice(found, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], pa.string()) for n in names], names)

    return pieces_of(filings, path_col, content_col, readings=1).mapInArrow(run, f"{HEADERS}, {LEGACY}")


#: The header as Spark's own XML reader sees it: text alone, so that leading zeros stay.
HEADER_SCHEMA = """_returnVersion string, ReturnData struct<_none:string>, ReturnHeader struct<TaxPeriodEndDt:string,TaxPeriodEndDate:string,TaxYr:string,TaxYear:string,ReturnTypeCd:string,
  Filer:struct<EIN:string,BusinessName:struct<BusinessNameLine1Txt:string,BusinessNameLine1:string>,Name:struct<BusinessNameLine1Txt:string,BusinessNameLine1:string>>>, bad string"""  # the reader wants the last place for what is malformed


def headers_by_schema(filings: DataFrame, *, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """SRC-3, SRC-4. The rows of ``headers`` without a Python worker: Spark's XML reader with a given schema.

    For documents in UTF-8 whose root is ``Return`` and whose filer stands directly in the header. It also takes names
    of other namespaces, and does not see what follows the root; ``headers`` is exact in these. Malformed documents,
    null ones and those with entities of their own are told apart.
    """
    text = F.col(content_col).cast("string")
    options = {"rowTag": "Return", "columnNameOfCorruptRecord": "bad", "ignoreNamespace": "true", "ignoreSurroundingSpaces": "true"}
    # a document without the root is no row of the reader, so all of it is null
    rows = filings.select(F.col(path_col).cast("string").alias("path"), F.from_xml(text, HEADER_SCHEMA, options).alias("x"), text.contains("<!ENTITY").alias("declares"), text.contains("<").alias("marked"))
    head, filer = F.col("x.ReturnHeader"), F.col("x.ReturnHeader.Filer")
    broken = F.col("x").isNull() | F.col("x.bad").isNotNull() | F.coalesce("declares", F.lit(True)) | ~F.coalesce("marked", F.lit(False))
    status = F.when(broken, "malformed").when(head.isNull(), "no_header").when(F.col("x.ReturnData").isNull(), "no_data").otherwise("ok")
    older = F.when(filer["BusinessName"].isNotNull(), F.coalesce(filer["BusinessName"]["BusinessNameLine1Txt"], filer["BusinessName"]["BusinessNameLine1"])).otherwise(F.coalesce(filer["Name"]["BusinessNameLine1Txt"], filer["Name"]["BusinessNameLine1"]))
    period = F.coalesce(*(F.nullif(head[c], F.lit("")) for c in ("TaxPeriodEndDt", "TaxPeriodEndDate", "TaxYr", "TaxYear")))
    values = {"return_version": F.col("x._returnVersion"), "ein": filer["EIN"], "tax_period": head["TaxPeriodEndDt"], "org_name": filer["BusinessName"]["BusinessNameLine1Txt"], "form_type": head["ReturnTypeCd"], "legacy_ein": filer["EIN"], "legacy_period": period, "legacy_name": older}
    return rows.select("path", status.alias("status"), *(F.when(broken, "").otherwise(F.coalesce(v, F.lit(""))).alias(n) for n, v in values.items()))


def shred_filings(filings: DataFrame, wanted: Iterable[str] | None = None, *, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """SRC-5. One row per element of each filing that parses: its path, order, text and enclosing elements.

    ``wanted``: paths to keep; others never leave the helper. It is a list of dictionary paths, which is
    small whatever the corpus. ``section`` is ``root_fallback`` where there is no data element.
    """
    kept = None if wanted is None else frozenset(wanted)
    shared = filings.sparkSession.sparkContext.broadcast(kept)
    schema = pa.schema([("path", pa.string()), ("return_version", pa.string()), ("status", pa.string()), ("section", pa.string()), ("xpath", pa.string()), ("doc_ord", pa.int64()), ("text", pa.string()), ("anc", pa.list_(pa.struct([("xpath", pa.string()), ("ord", pa.int64())]))), ("in_root_ns", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only, rows = shared.value, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            flat = [a for anc in columns[7] for a in anc]
            offsets, at = [0], 0
            for anc in columns[7]:
                at += len(anc)
                offsets.append(at)
            pairs = pa.StructArray.from_arrays([pa.array([x for x, _ in flat], pa.string()), pa.array([n for _, n in flat], pa.int64())], ["xpath", "ord"])
            arrays = [pa.array(c, f.type) for c, f in zip(columns[:7], schema, strict=False)]
            return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs), pa.array(columns[8], pa.bool_())], [f.name for f in schema])

        for path, filing in filings_in(batches, only):
            if not filing:
                continue
            own = header_of(filing)
            for element in filing.elements():
                rows.append((path, own["return_version"], own["status"], *element))
                if len(rows) >= BATCH:
                    yield out()
                    rows = []
        if rows:
            yield out()

    return pieces_of(filings, path_col, content_col).mapInArrow(run, ELEMENTS)


def status_counts(heads: DataFrame) -> DataFrame:
    """SRC-7. Filings by status."""
    return heads.groupBy("status").agg(F.count("*").alias("filings"))


def forms_present(elements: DataFrame) -> DataFrame:
    """SRC-6. (path, schedules, form_type): the sorted IRS forms of each filing, and the last of the main forms."""
    name = F.substring_index("xpath", "/", -1)
    top = elements.where((F.size("anc") == 0) & name.startswith("IRS")).select("path", "doc_ord", name.alias("tag"))
    main = F.when(F.col("tag").isin("IRS990", "IRS990EZ", "IRS990PF"), F.col("doc_ord"))
    return top.groupBy("path").agg(F.array_sort(F.collect_set("tag")).alias("schedules"), F.coalesce(F.max_by("tag", main), F.lit("")).alias("form_type"))


TEXTS = ("texts", "map<string,string>", pa.map_(pa.string(), pa.string()))
BOXES = ("boxes", "array<struct<container:string,number:int,texts:map<string,string>>>", pa.list_(pa.struct([("container", pa.string()), ("number", pa.int32()), TEXTS[::2]])))
PATHS = ("paths", "array<struct<xpath:string,n:long,sample:string>>", pa.list_(pa.struct([("xpath", pa.string()), ("n", pa.int64()), ("sample", pa.string())])))


def per_filing(filings: DataFrame, columns: tuple, extra: Callable[[Filing], tuple[list, ...]], path_col: str, content_col: str, wanted: Callable[[], frozenset[str] | None] = lambda: None) -> DataFrame:
    """Header rows with further list columns, which ``extra`` makes of a filing (false: malformed) with its ``wanted`` elements.

    One row per filing and no shuffle: a filing lies whole in one row.
    """
    heads = f"{HEADERS}, {LEGACY}"
    names, added = [x.split()[0] for x in heads.split(", ")], [name for name, _, _ in columns]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size = 0

        def out() -> pa.RecordBatch:
            arrays = [pa.array([r[n] for r in rows], pa.string()) for n in names]
            return pa.RecordBatch.from_arrays([*arrays, *(pa.array([r[n] for r in rows], kind) for n, _, kind in columns)], [*names, *added])

        for path, filing in filings_in(batches, wanted()):
            found = extra(filing)
            rows.append(header_of(filing) | {"path": path} | dict(zip(added, found, strict=True)))
            size += 1 + sum(map(len, found))
            if size >= BATCH:
                yield out()
                rows, size = [], 0
        if rows:
            yield out()

    schema = ", ".join([heads, *(f"{name} {ddl}" for name, ddl, _ in columns)])
    return pieces_of(filings, path_col, content_col).mapInArrow(run, schema)


def texts_and_boxes(filings: DataFrame, wanted: Iterable[str], containers: Iterable[str] = (), members: Iterable[str] = (), *, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """Header rows with ``texts``: map of each wanted path to the text of its first element in the root's namespace,
    and ``boxes``: every element of ``containers`` in document order, numbered by path, with the first text of each of ``members`` inside it.

    Paths that do not occur are not in the maps.
    """
    shared = filings.sparkSession.sparkContext.broadcast(tuple(map(frozenset, (wanted, containers, members))))

    def extra(filing: Filing) -> tuple[list, list]:
        only, holders, inner = shared.value
        texts: dict[str, str] = {}
        boxes: dict[int, tuple[str, dict[str, str]]] = {}
        for section, xpath, number, text, anc, inside in filing.elements() if filing else ():
            if not inside or section != "data":
                continue
            if xpath in only:
                texts.setdefault(xpath, text)
            if xpath in inner:
                for _, at in anc:
                    if at in boxes:
                        boxes[at][1].setdefault(xpath, text)
            if xpath in holders:
                boxes[number] = xpath, {}
        numbers: dict[str, int] = {}
        out = []
        for xpath, own in boxes.values():
            numbers[xpath] = number = numbers.get(xpath, 0) + 1
            out.append({"container": xpath, "number": number, "texts": list(own.items())})
        return list(texts.items()), out

    return per_filing(filings, (TEXTS, BOXES), extra, path_col, content_col, lambda: frozenset().union(*shared.value))


def first_texts(filings: DataFrame, wanted: Iterable[str], *, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """``texts_and_boxes`` without containers."""
    return texts_and_boxes(filings, wanted, path_col=path_col, content_col=content_col).drop("boxes")


def path_counts(filings: DataFrame, sample: int, *, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """Header rows with ``paths``: each path of the filing, how often it occurs and its first text that is not empty, cut to ``sample`` characters."""

    def extra(filing: Filing) -> tuple[list]:
        held: dict[str, list] = {}
        for _, xpath, _, text, _, _ in filing.elements() if filing else ():
            own = held.setdefault(xpath, [0, ""])
            own[0] += 1
            own[1] = own[1] or text[:sample]
        return ([{"xpath": xpath, "n": n, "sample": text} for xpath, (n, text) in held.items()],)

    return per_filing(filings, (PATHS,), extra, path_col, content_col)

"""Event parsing against a walk over whole trees, in pieces of any size, and its memory."""

import io
import random
import tracemalloc
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from filing_jobs.sources import shred
from filing_jobs.sources.shred import WRAPPERS, Filing, header_of


def whole_tree(content):
    """(header, elements) by the document's tree; None if it is malformed."""
    if content is None or b"<!ENTITY" in content:
        return None
    try:
        root = ElementTree.parse(io.BytesIO(content), ElementTree.XMLParser(target=ElementTree.TreeBuilder(insert_comments=True, insert_pis=True))).getroot()
    except (ElementTree.ParseError, ValueError, LookupError):
        return None
    space = root.tag[1:].partition("}")[0] if root.tag[0] == "{" else ""
    mark = "{%s}" % space if space else ""
    header, data = root.find(f"{mark}ReturnHeader"), root.find(f"{mark}ReturnData")
    text = lambda e: (e.text or "").strip() if e is not None else ""
    head = ("no_header" if header is None else "no_data" if data is None else "ok", root.get("returnVersion", ""))
    head += tuple(text(header.find(x)) for x in (f".//{mark}Filer/{mark}EIN", f"{mark}TaxPeriodEndDt", f".//{mark}Filer/{mark}BusinessName/{mark}BusinessNameLine1Txt", f"{mark}ReturnTypeCd")) if header is not None else ("",) * 4
    rows, number = [], 0

    def walk(e, above, anc, inside):
        nonlocal number
        for c in e:
            if not isinstance(c.tag, str):
                continue
            own_space, name = c.tag[1:].split("}", 1) if c.tag[0] == "{" else ("", c.tag)
            within, xpath, below = inside and own_space == space, "", ()
            if name not in WRAPPERS:
                xpath = f"{above}/{name}"
                rows.append(("root_fallback" if data is None else "data", xpath, number, text(c), anc, within))
                below = (*anc, (xpath, number))
            number += 1
            walk(c, xpath, below, within)

    walk(root if data is None else data, "", (), True)
    return head, rows


def random_document(r):
    def element(depth):
        name = r.choice(["IRS990", "AGrp", "BAmt", "ReturnData", "ReturnHeader", "Return", "Filer", "EIN", "x:Other", "TaxPeriodEndDt", "BusinessName", "BusinessNameLine1Txt"])
        inner = "".join(r.choice([lambda: r.choice(["", " ", "text", "\n é&amp;&#x41; ", "<![CDATA[<raw> ]]>", "<!-- c -->", "<?pi x?>", "🙂"]), lambda: element(depth + 1) if depth < 5 else ""])() for _ in range(r.randint(0, 4)))
        return f"<{name}>{inner}</{name}>" if inner or r.random() < 0.5 else f"<{name} a='1'/>"

    parts = [element(1) for _ in range(r.randint(0, 3))]
    parts += [f"<ReturnHeader><!-- c -->{element(2)}<Filer><EIN>1<!-- c -->2</EIN>{element(3)}</Filer></ReturnHeader>"] * r.choice([0, 1, 1, 2]) + [f"<ReturnData>{element(2)}{element(2)}</ReturnData>"] * r.choice([0, 1, 1, 2])
    r.shuffle(parts)
    space = r.choice(["", ' xmlns="urn:a"', ' xmlns="urn:a}b"'])
    text = r.choice(["", '<?xml version="1.0" encoding="UTF-8"?>\n', "<!DOCTYPE Return>"]) + f'<Return{space} xmlns:x="urn:x" returnVersion="2020v4.2">{"".join(parts)}</Return>'
    return r.choice([text] * 8 + [text[: r.randrange(len(text))], text + "<again/>", text.replace("</", "<", 1), text.replace("text", "&none;")])


@pytest.mark.parametrize("step", [1, 7, 1 << 16])
def test_events_equal_the_tree(monkeypatch, step):
    monkeypatch.setattr(shred, "STEP", step)
    r, kinds = random.Random(step), set()
    for _ in range(1500):
        content = random_document(r).encode()
        cut = r.choice([1, 5, 64, 10**6])
        pieces, small = lambda: (content[k : k + cut] for k in range(0, len(content), cut)), r.random() < 0.5  # noqa: B023, E731
        filing = Filing(pieces, False, small=small)
        tree = whole_tree(content)
        assert bool(filing) == (tree is not None), content
        if tree is None:
            continue
        head = header_of(filing)
        assert tuple(head[c] for c in ("status", "return_version", "ein", "tax_period", "org_name", "form_type")) == tree[0], content
        assert list(filing.elements()) == tree[1], content
        some = frozenset(x[1] for x in tree[1][::2])
        assert list(Filing(pieces, False, some, small=small).elements()) == [x for x in tree[1] if x[1] in some]
        kinds.add(tree[0][0])
    assert kinds == {"ok", "no_header", "no_data"}


@pytest.mark.parametrize("decoded", [False, True])
def test_large_filings_come_in_pieces(spark, monkeypatch, decoded):
    monkeypatch.setattr(shred, "PIECE", 40)
    r = random.Random(3)
    docs = [random_document(r) for _ in range(150)] + ["", "<a/>", None]
    if decoded:
        docs.append(' \n<?xml version="1.0" encoding="ISO-8859-1"?><Return><ReturnData><é>ü</é></ReturnData></Return>')
    rows = [(f"{k:04d}", d if decoded or d is None else d.encode()) for k, d in enumerate(docs)]
    df = spark.createDataFrame(rows, f"path string, content {'string' if decoded else 'binary'}").repartition(3)
    trees = {k: whole_tree(None if d is None else (d.encode() if not decoded else d.split("?>", 1)[1].encode() if d.lstrip().startswith("<?xml") else d.encode())) for (k, _), d in zip(rows, docs, strict=True)}
    heads = {x["path"]: (x["status"], x["return_version"], x["ein"]) for x in shred.headers(df).collect()}
    assert heads == {k: ("malformed", "", "") if t is None else t[0][:3] for k, t in trees.items()}
    got = sorted((x["path"], x["doc_ord"], x["section"], x["xpath"], x["text"], tuple((a["xpath"], a["ord"]) for a in x["anc"]), x["in_root_ns"]) for x in shred.shred_filings(df).collect())
    assert got == sorted((k, n, s, x, t, a, i) for k, tree in trees.items() if tree for s, x, n, t, a, i in tree[1])
    counts = {x["path"]: {p["xpath"]: p["n"] for p in x["paths"]} for x in shred.path_counts(df, 100).collect()}
    assert all(counts[k] == {x: sum(e[1] == x for e in t[1]) for x in {e[1] for e in t[1]}} for k, t in trees.items() if t)


def test_memory_follows_depth_and_not_size():
    group = b"<AGrp><BAmt>1</BAmt><CDesc>" + b"words " * 20 + b"</CDesc></AGrp>"
    head, tail = b'<Return returnVersion="2020v4.2"><ReturnHeader/><ReturnData><IRS990>', b"</IRS990></ReturnData></Return>"

    def pieces(n):
        yield head
        for _ in range(n):
            yield group * 500
        yield tail

    tracemalloc.start()
    filing = Filing(lambda: pieces(400), False)  # 33 MB
    found = sum(1 for _ in filing.elements())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 1 + 400 * 500 * 3 and peak < 3_000_000


def test_entities_are_refused_and_mentions_of_them_are_not(spark):
    docs = [("a", '<!DOCTYPE r [<!ENTITY a "b">]><Return/>'), ("b", "<Return><!-- <!ENTITY a 'b'> --></Return>"), ("c", "<!DOCTYPE r SYSTEM 'x.dtd'><Return>&a;</Return>")]
    got = {x["path"]: x["status"] for x in shred.headers(spark.createDataFrame(docs, "path string, content string").withColumn("k", F.lit(1))).collect()}
    assert got == {"a": "malformed", "b": "no_header", "c": "malformed"}

"""The RDF/XML reader, case by case of the grammar."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pytest

from corpusweave.sources import rdfxml
from corpusweave.sources.rdfxml import RDF, Reader

EX = "http://e/"


def read(body, head='xml:base="http://e/doc"', graph="g"):
    text = f'<?xml version="1.0"?><rdf:RDF xmlns:rdf="{RDF}" xmlns:ex="{EX}" {head}>{body}</rdf:RDF>'
    return [(s.replace(EX, ""), p.replace(EX, "").replace(RDF, "rdf:"), o.replace(EX, "").replace(RDF, "rdf:"), kind, lang, dtype and dtype.replace(EX, "").replace(RDF, "rdf:")) for s, p, o, kind, lang, dtype in Reader(graph).read(text.encode())]


def iri(s, p, o):
    return s, p, o, "bnode" if o.startswith("_:") else "iri", None, None


def text(s, p, o, lang=None, dtype=None):
    return s, p, o, "literal", lang, dtype


CASES = {
    "property attributes": ('<rdf:Description rdf:about="a" ex:p="x" rdf:type="T" xml:lang="en"/>', [text("a", "p", "x", "en"), iri("a", "rdf:type", "T")]),
    "typed node": ('<ex:T rdf:about="a"/>', [iri("a", "rdf:type", "T")]),
    "rdf:ID": ('<rdf:Description rdf:ID="x"><ex:p rdf:resource="#y"/></rdf:Description>', [iri("doc#x", "p", "doc#y")]),
    "empty reference": ('<rdf:Description rdf:about=""><ex:p rdf:resource=""/></rdf:Description>', [iri("doc", "p", "doc")]),
    "blank nodes": ('<rdf:Description><ex:p rdf:nodeID="n"/></rdf:Description><rdf:Description rdf:nodeID="n" ex:q="1"/>', [iri("_:g.1", "p", "_:g-n"), text("_:g-n", "q", "1")]),
    "nested": ('<rdf:Description rdf:about="a"><ex:p><ex:T rdf:about="b"><ex:q>1</ex:q></ex:T></ex:p></rdf:Description>', [iri("b", "rdf:type", "T"), text("b", "q", "1"), iri("a", "p", "b")]),
    "several nodes": ('<rdf:Description rdf:about="a"><ex:p><rdf:Description rdf:about="b"/><rdf:Description rdf:about="c"/></ex:p></rdf:Description>', [iri("a", "p", "b"), iri("a", "p", "c")]),
    "parseType Resource": ('<rdf:Description rdf:about="a"><ex:p rdf:parseType="Resource"><ex:q>1</ex:q></ex:p></rdf:Description>', [text("_:g.1", "q", "1"), iri("a", "p", "_:g.1")]),
    "parseType Collection": (
        '<rdf:Description rdf:about="a"><ex:p rdf:parseType="Collection"><rdf:Description rdf:about="b"/><rdf:Description rdf:about="c"/></ex:p><ex:q rdf:parseType="Collection"/></rdf:Description>',
        [iri("_:g.1", "rdf:first", "b"), iri("_:g.1", "rdf:rest", "_:g.2"), iri("_:g.2", "rdf:first", "c"), iri("_:g.2", "rdf:rest", "rdf:nil"), iri("a", "p", "_:g.1"), iri("a", "q", "rdf:nil")],
    ),
    "parseType Literal": (
        '<rdf:Description rdf:about="a"><ex:p rdf:parseType="Literal" xml:lang="en">x &lt; <ex:b k="&quot;1">y<ex:c/></ex:b> z</ex:p></rdf:Description>',
        [text("a", "p", "x &lt; <ex:b xmlns:ex=\"\" k='\"1'>y<ex:c></ex:c></ex:b> z", None, "rdf:XMLLiteral")],
    ),
    "property attributes of a property": ('<rdf:Description rdf:about="a"><ex:p ex:q="1" rdf:type="T"/><ex:r rdf:resource="b" ex:q="2"/></rdf:Description>', [iri("a", "p", "_:g.1"), text("_:g.1", "q", "1"), iri("_:g.1", "rdf:type", "T"), iri("a", "r", "b"), text("b", "q", "2")]),
    "named statement": ('<rdf:Description rdf:about="a"><ex:p rdf:ID="s">x</ex:p></rdf:Description>', [text("a", "p", "x"), iri("doc#s", "rdf:type", "rdf:Statement"), iri("doc#s", "rdf:subject", "a"), iri("doc#s", "rdf:predicate", "p"), text("doc#s", "rdf:object", "x")]),
    "members": ('<rdf:Bag rdf:about="a"><rdf:li>x</rdf:li><rdf:_7>y</rdf:_7><rdf:li rdf:resource="b"/></rdf:Bag>', [iri("a", "rdf:type", "rdf:Bag"), text("a", "rdf:_1", "x"), text("a", "rdf:_7", "y"), iri("a", "rdf:_2", "b")]),
    "languages": ('<rdf:Description rdf:about="a" xml:lang="sk"><ex:p>x</ex:p><ex:p xml:lang="">y</ex:p><ex:p xml:lang="en">z</ex:p><ex:p rdf:datatype="http://e/d">1</ex:p></rdf:Description>', [text("a", "p", "x", "sk"), text("a", "p", "y"), text("a", "p", "z", "en"), text("a", "p", "1", None, "d")]),
    "bases": ('<rdf:Description rdf:about="a" xml:base="http://e/sub/x#f"><ex:p rdf:resource="b"/><ex:p xml:base="http://e/" rdf:resource="b"/></rdf:Description>', [iri("sub/a", "p", "sub/b"), iri("sub/a", "p", "b")]),
    "white space and entities": ('<rdf:Description rdf:about="a"><ex:p> x &amp; y<!-- no -->\n</ex:p><ex:p/></rdf:Description>', [text("a", "p", " x & y\n"), text("a", "p", "")]),
}


@pytest.mark.parametrize("name", CASES)
def test_case(name, monkeypatch):
    body, want = CASES[name]
    for chunk in (1 << 16, 7):
        monkeypatch.setattr(rdfxml, "_CHUNK", chunk)
        assert sorted(read(body), key=repr) == sorted(want, key=repr)


def test_roots():
    assert list(Reader("g").read(f'<rdf:Description xmlns:rdf="{RDF}" xmlns:ex="{EX}" rdf:about="x" ex:p="1"/>'.encode())) == [("x", EX + "p", "1", "literal", None, None)]
    assert read("", "") == [] and read('<rdf:Description rdf:ID="a" ex:p="1"/>', 'xml:lang="en"') == [text("#a", "p", "1", "en")]
    with pytest.raises(ET.ParseError):
        list(Reader("g").read(b"<a><b></a>"))
    with pytest.raises(ET.ParseError):
        list(Reader("g").read(b""))


def test_large_documents_in_little_memory():
    import tracemalloc

    node = '<rdf:Description rdf:about="n"><ex:p>' + "x" * 200 + "</ex:p></rdf:Description>"
    content = (f'<rdf:RDF xmlns:rdf="{RDF}" xmlns:ex="{EX}">' + node * 20_000 + "</rdf:RDF>").encode()
    tracemalloc.start()
    assert sum(1 for _ in Reader("g").read(content)) == 20_000
    assert tracemalloc.get_traced_memory()[1] < len(content) / 2
    tracemalloc.stop()

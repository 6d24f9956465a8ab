"""An incremental reader of RDF/XML: the whole grammar, one top-level node in memory at a time."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from urllib.parse import urldefrag, urljoin
from xml.sax.saxutils import escape, quoteattr

# The names of the syntax.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
_XML = "{http://www.w3.org/XML/1998/namespace}"
_SYNTAX = {f"{{{RDF}}}{n}" for n in ("about", "ID", "nodeID", "resource", "datatype", "parseType", "bagID", "aboutEach", "aboutEachPrefix", "li", "RDF", "Description")}
_CHUNK = 1 << 16

Triple = tuple[str, str, str, str, str | None, str | None]


def _name(tag: str) -> str:
    return tag[1:].replace("}", "", 1) if tag.startswith("{") else tag


class Reader:
    """s, p, o, o_kind (iri, bnode, literal), o_lang, o_dtype of a document.

    Nodes and property elements, property attributes, rdf:ID (also as the name of a statement), rdf:nodeID, rdf:li, parseType Resource, Collection and
    Literal (any other value counts as Literal), and xml:base and xml:lang as inherited. Blank nodes are named by the graph and
    their nodeID, or a number in order of the document. Of several nodes inside a property element each is a value. Relative references stay as they are without a
    base. What isn't well-formed is an error.
    """

    def __init__(self, graph: str, base: str = ""):
        self.graph, self.base, self.lang, self.count = graph, base, None, 0
        self.prefixes: dict[str, str] = {}

    def read(self, content: bytes) -> Iterator[Triple]:
        pull, open_ = ET.XMLPullParser(["start", "end", "start-ns"]), []
        for at in range(0, max(len(content), 1), _CHUNK):
            pull.feed(content[at : at + _CHUNK])
            yield from self._events(pull, open_)
        pull.close()
        yield from self._events(pull, open_)

    def _events(self, pull: ET.XMLPullParser, open_: list[ET.Element]) -> Iterator[Triple]:
        for event, e in pull.read_events():
            if event == "start-ns":
                self.prefixes.setdefault(e[1], e[0])
            elif event == "start":
                open_.append(e)
                if len(open_) == 1 and e.tag == f"{{{RDF}}}RDF":
                    self.lang, self.base = self._scope(e, None, self.base)
            else:
                open_.pop()
                in_rdf = len(open_) == 1 and open_[0].tag == f"{{{RDF}}}RDF"
                if in_rdf or (not open_ and e.tag != f"{{{RDF}}}RDF"):
                    out: list[Triple] = []
                    self._node(e, self.lang, self.base, out)
                    yield from out
                    (open_[0] if open_ else e).clear()

    @staticmethod
    def _scope(e: ET.Element, lang: str | None, base: str) -> tuple[str | None, str]:
        own, root = e.get(f"{_XML}lang"), e.get(f"{_XML}base")
        return (lang if own is None else own or None), (base if root is None else urldefrag(urljoin(base, root))[0])

    def _fresh(self) -> str:
        self.count += 1
        return f"_:{self.graph}.{self.count}"

    def _named(self, node_id: str) -> str:
        return f"_:{self.graph}-{node_id}"

    @staticmethod
    def _resolve(base: str, ref: str) -> str:
        return urljoin(base, ref) if base and ref else base or ref

    def _attributes(self, e: ET.Element, s: str, lang: str | None, base: str, out: list[Triple]) -> None:
        for k, v in e.attrib.items():
            if k == f"{{{RDF}}}type":
                out.append((s, RDF + "type", self._resolve(base, v), "iri", None, None))
            elif k.startswith("{") and not k.startswith(_XML) and k not in _SYNTAX:
                out.append((s, _name(k), v, "literal", lang, None))

    def _node(self, e: ET.Element, lang: str | None, base: str, out: list[Triple]) -> str:
        lang, base = self._scope(e, lang, base)
        about, own, node_id = (e.get(f"{{{RDF}}}{n}") for n in ("about", "ID", "nodeID"))
        s = self._resolve(base, about) if about is not None else f"{base}#{own}" if own is not None else self._named(node_id) if node_id is not None else self._fresh()
        if e.tag != f"{{{RDF}}}Description":
            out.append((s, RDF + "type", _name(e.tag), "iri", None, None))
        self._attributes(e, s, lang, base, out)
        self._properties(e, s, lang, base, out)
        return s

    def _properties(self, e: ET.Element, s: str, lang: str | None, base: str, out: list[Triple]) -> None:
        item = 0
        for child in e:
            p = _name(child.tag)
            if child.tag == f"{{{RDF}}}li":
                item += 1
                p = f"{RDF}_{item}"
            self._property(child, s, p, *self._scope(child, lang, base), out)

    def _property(self, e: ET.Element, s: str, p: str, lang: str | None, base: str, out: list[Triple]) -> None:
        parse, resource, node_id, dtype, own = (e.get(f"{{{RDF}}}{n}") for n in ("parseType", "resource", "nodeID", "datatype", "ID"))
        kind = lambda o: "bnode" if o.startswith("_:") else "iri"
        more = any(k == f"{{{RDF}}}type" or (k.startswith("{") and not k.startswith(_XML) and k not in _SYNTAX) for k in e.attrib)
        said: list[Triple] = []
        if parse == "Resource":
            o = self._fresh()
            said.append((s, p, o, "bnode", None, None))
            self._properties(e, o, lang, base, out)
        elif parse == "Collection":
            nodes = [self._node(c, lang, base, out) for c in e]
            cells = [self._fresh() for _ in nodes]
            for k, (cell, node) in enumerate(zip(cells, nodes, strict=True)):
                out.append((cell, RDF + "first", node, kind(node), None, None))
                rest = cells[k + 1] if k + 1 < len(cells) else RDF + "nil"
                out.append((cell, RDF + "rest", rest, kind(rest), None, None))
            o = cells[0] if cells else RDF + "nil"
            said.append((s, p, o, kind(o), None, None))
        elif parse is not None:
            said.append((s, p, self._markup(e), "literal", None, RDF + "XMLLiteral"))
        elif len(e):
            for child in e:
                o = self._node(child, lang, base, out)
                said.append((s, p, o, kind(o), None, None))
        elif resource is not None or node_id is not None or more:
            o = self._resolve(base, resource) if resource is not None else self._named(node_id) if node_id is not None else self._fresh()
            said.append((s, p, o, "bnode" if resource is None else "iri", None, None))
            self._attributes(e, o, lang, base, out)
        else:
            dtype = self._resolve(base, dtype) if dtype is not None else None
            said.append((s, p, e.text or "", "literal", lang if dtype is None else None, dtype))
        out.extend(said)
        if own is not None:
            name = f"{base}#{own}"
            for s_, p_, o_, *rest in said[:1]:
                out.append((name, RDF + "type", RDF + "Statement", "iri", None, None))
                out.append((name, RDF + "subject", s_, kind(s_), None, None))
                out.append((name, RDF + "predicate", p_, "iri", None, None))
                out.append((name, RDF + "object", o_, *rest))

    def _markup(self, e: ET.Element) -> str:
        """What is inside an element, with the namespaces that each part needs declared where they are first used."""
        return escape(e.text or "") + "".join(self._element(c, {}) + escape(c.tail or "") for c in e)

    def _element(self, e: ET.Element, known: dict[str, str]) -> str:
        used: dict[str, str] = {}

        def short(tag: str, attribute: bool = False) -> str:
            if not tag.startswith("{"):
                return tag
            ns, local = tag[1:].split("}", 1)
            if tag.startswith(_XML):
                return f"xml:{local}"
            prefix = self.prefixes.get(ns, "")
            if attribute and not prefix:
                prefix = "ns"
            used[prefix] = ns
            return f"{prefix}:{local}" if prefix else local

        name = short(e.tag)
        attributes = "".join(f" {short(k, True)}={quoteattr(v)}" for k, v in sorted(e.attrib.items()))
        new = {p: ns for p, ns in used.items() if known.get(p) != ns}
        declared = "".join(f" xmlns{':' if p else ''}{p}={quoteattr(ns)}" for p, ns in sorted(new.items()))
        inner = escape(e.text or "") + "".join(self._element(c, known | new) + escape(c.tail or "") for c in e)
        return f"<{name}{declared}{attributes}>{inner}</{name}>"

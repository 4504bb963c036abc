"""The service by its methods and over the wire; downloads from a folder."""

import bz2
import json
import threading
import urllib.error
import urllib.request

import pytest

from pagequarry.plans import fixtures
from pagequarry.service import Service, answer, server
from pagequarry.sources.download import download

MAPPING = "{{TemplateMapping|mapToClass=Town|mappings={{PropertyMapping|templateProperty=population|ontologyProperty=people}}}}"
ONTOLOGY = {
    "OntologyClass:Town": "{{Class|labels={{label|en|town}}|rdfs:subClassOf=Place}}", "OntologyClass:Place": "{{Class|rdfs:label@de=Ort}}",
    "OntologyProperty:people": "{{DatatypeProperty|rdfs:domain=Town|rdfs:range=xsd:integer}}",
}


@pytest.fixture()
def service(spark):
    return Service(spark, fixtures.pages(spark), {"Mapping en:Infobox town": MAPPING}, dict(ONTOLOGY))


def test_extraction(service):
    lines = service.extract(["labels", "page-links"], title="Ada Stein")
    assert len(lines) == 3 and any("Poets" in x for x in lines)
    assert service.extract(["page-ids"], "n-triples", revision=12) == [x for x in service.extract(["page-ids"], "n-triples", title="Ada Stein")]
    xml = '<mediawiki xml:lang="en"><page><title>New</title><ns>0</ns><id>77</id><revision><id>1</id><text>[[B]]</text></revision></page></mediawiki>'
    assert service.extract(["page-links"], xml=xml) == ["<http://en.example.org/resource/New> <http://example.org/ontology/wikiPageWikiLink> <http://en.example.org/resource/B> ."]
    assert any(x["name"] == "infobox" and x["text"] for x in service.extractors())


def test_mappings_and_ontology(service):
    assert service.validate("Mapping en:X", MAPPING) == [] and service.validate("Mapping en:X", "") == ["nothing is mapped"]
    bad = MAPPING.replace("Town", "Village").replace("people", "souls")
    assert service.put_mapping("Mapping en:X", bad) == ["no class Village", "no property souls"] and "Mapping en:X" not in service.mapping_pages
    assert any("12345" in x for x in service.sample("Mapping en:Infobox town"))
    assert service.missing_labels("en") == ["Place", "people"]
    assert len(service.ontology_text("owl")) == 3 and any("subClassOf" in x for x in service.ontology_text())


def test_statistics(service):
    rows = {r["template"]: (r["n"], r["mapped"]) for r in service.template_statistics()}
    assert rows["Infobox town"] == (1, True) and rows["Persondata"] == (1, False)
    keys = {r["key"]: r["mapped"] for r in service.property_statistics("Infobox town")}
    assert keys["population"] and not keys["mayor"]
    before = service.coverage()
    assert service.ignore("Persondata") == ["Persondata"] and service.coverage()["names"] == before["names"] - 1


def test_over_the_wire(service):
    web = server(service)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{web.server_port}"

    def ask(method, path, body=None):
        request = urllib.request.Request(base + path, data=None if body is None else body.encode(), method=method)
        try:
            with urllib.request.urlopen(request) as got:
                return got.status, json.load(got)
        except urllib.error.HTTPError as failed:
            return failed.code, json.load(failed)

    assert len(ask("GET", "/extraction/extract?title=Mercury&extractors=labels")[1]) == 1
    assert ask("PUT", "/mappings/pages?title=Mapping%20en:Y", MAPPING) == (200, [])
    assert ask("GET", "/mappings/pages")[1] == ["Mapping en:Infobox town", "Mapping en:Y"]
    assert ask("DELETE", "/mappings/pages?title=Mapping%20en:Y")[0] == 200 and ask("DELETE", "/mappings/pages?title=none")[0] == 404
    assert ask("GET", "/ontology/classes") == (200, ["Place", "Town"])
    assert ask("GET", "/nowhere")[0] == 404 and ask("GET", "/statistics/properties")[0] == 400
    web.shutdown()
    assert answer(service, "GET", "/ontology/missing-labels?language=de") == (200, ["Town", "people"])


def test_download(tmp_path):
    source = tmp_path / "there" / "dump.xml.bz2"
    source.parent.mkdir()
    source.write_bytes(bz2.compress(b"<page/>" * 1000))
    seen = []
    plain = download(source.as_uri(), str(tmp_path / "here"), progress=seen.append)
    assert plain.read_bytes() == source.read_bytes() and seen[-1] == source.stat().st_size
    stamp = plain.stat().st_mtime_ns
    plain.write_bytes(b"kept")
    import os

    os.utime(plain, ns=(stamp, stamp))
    assert download(source.as_uri(), str(tmp_path / "here")).read_bytes() == b"kept"
    unpacked = download(source.as_uri(), str(tmp_path / "open"), unpack=True)
    assert unpacked.name == "dump.xml" and unpacked.read_bytes() == b"<page/>" * 1000
    with pytest.raises(OSError):
        download((tmp_path / "none").as_uri(), str(tmp_path / "here"), tries=2, pause=0)
    assert not list((tmp_path / "here").glob("*.part"))

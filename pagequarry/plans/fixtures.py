"""Hand-written pages and items for queries and tests; the tables of the driver hold no wikitext."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession

from pagequarry.sources.pages import memory

TS = datetime.datetime(2024, 5, 6, 7, 8, 9)

TOWN = """{{Infobox town
| name = Bruck
| population = 12,345
| area = 42.5 km2
| founded = 3 May 1250
| mayor = [[Ada Stein|A. Stein]]
| website = http://bruck.example/
| twin = [[Ulm]]<br />[[Graz]]
}}
{{coord|47|24|N|15|16|E}}
'''Bruck''' is a town (; old) in [[Styria]]. It lies on the [[Mur (river)|Mur]].<ref name="a">{{cite web|url=http://a.example/x|title=On Bruck|year=1999}}</ref>

== History ==
See [[History of Bruck]] and [http://h.example/ the archive].

=== Wars ===
{| class="wikitable"
! Year !! Event
|-
| rowspan="2" | 1290 || Siege
|-
| Fire
|}
[[Category:Towns in Styria]]
[[:Category:Rivers]]
[[de:Bruck an der Mur]]
[[File:Bruck view.jpg|thumb|A view]]
"""
POET = """{{Persondata
| NAME = Stein, Ada
| SHORT DESCRIPTION = poet
| DATE OF BIRTH = 1 March 1901
| PLACE OF BIRTH = [[Bruck]]
| DATE OF DEATH = 1980
}}
'''Ada Stein''' wrote. She lived in [[Bruck]] and she loved it. Her house stands; she sold it herself. He came.
{{Official website|www.stein.example}}
[[Category:Poets]]
"""
PAGES = [
    dict(page_id=1, title="Bruck", ns=0, revision=11, ts=TS, contributor_id=5, contributor_name="Ed Itor", source=TOWN),
    dict(page_id=2, title="Ada Stein", ns=0, revision=12, ts=TS, contributor_id=0, contributor_name="", source=POET),
    dict(page_id=3, title="Bruck an der Mur", ns=0, revision=13, ts=TS, contributor_id=5, contributor_name="Ed Itor", redirect="Bruck", source="#REDIRECT [[Bruck]]"),
    dict(page_id=4, title="Mercury", ns=0, revision=14, ts=TS, contributor_id=6, contributor_name="X", source="* [[Mercury (planet)]]\n* [[Mercury (element)]]\n* [[Hermes]]\n{{disambiguation}}"),
    dict(page_id=5, title="Category:Towns in Styria", ns=14, revision=15, ts=TS, contributor_id=6, contributor_name="X", source="{{Cat main|Styria}}\n[[Category:Styria]]\n[[:Category:Towns]]"),
    dict(page_id=6, title="Template:Infobox town", ns=10, revision=16, ts=TS, contributor_id=6, contributor_name="X", source="{{{name|}}} {{{population}}} {{{area|{{#property:P2046}}}}} {{#if:{{{mayor|}}}|x|{{#property:P6}}}}"),
    dict(page_id=7, title="File:Bruck view.jpg", ns=6, revision=17, ts=TS, contributor_id=6, contributor_name="X", source="{{ImageNote|x=1|y=2|w=3|h=4}}the tower{{ImageNoteEnd}}"),
    dict(page_id=8, title="Broken {{", ns=0, revision=18, ts=TS, contributor_id=6, contributor_name="X", source="open {{never closed [[nor this\n<gallery>\nFile:One.png|first\nFile:Two.png\n</gallery>\n<!-- [[hidden]] --> <nowiki>[[raw]]</nowiki>"),
    dict(page_id=9, title="Zürich", ns=0, revision=19, ts=TS, contributor_id=6, contributor_name="X", source=""),
]
ITEM = {
    "id": "Q1", "type": "item", "labels": {"en": {"language": "en", "value": "Bruck"}, "ja": {"language": "ja", "value": "ブルック"}}, "descriptions": {"en": {"language": "en", "value": "town"}},
    "aliases": {"en": [{"language": "en", "value": "Brugg"}, {"language": "en", "value": "Bruk"}]}, "sitelinks": {"enwiki": {"site": "enwiki", "title": "Bruck"}, "dewiki": {"site": "dewiki", "title": "Bruck an der Mur"}, "commonswiki": {"site": "commonswiki", "title": "Bruck"}},
    "claims": {
        "P31": [{"id": "Q1$AAAAA-1", "rank": "normal", "mainsnak": {"snaktype": "value", "property": "P31", "datavalue": {"type": "wikibase-entityid", "value": {"id": "Q2"}}}, "references": [{"hash": "h", "snaks": {"P854": [{"snaktype": "value", "property": "P854", "datavalue": {"type": "string", "value": "http://r.example/"}}]}}]}],
        "P571": [{"id": "Q1$BBBBB-1", "rank": "normal", "mainsnak": {"snaktype": "value", "property": "P571", "datavalue": {"type": "time", "value": {"time": "+1250-05-03T00:00:00Z", "precision": 11, "calendarmodel": "http://www.wikidata.org/entity/Q1985786"}}}, "qualifiers": {"P1480": [{"snaktype": "value", "property": "P1480", "datavalue": {"type": "string", "value": "about"}}]}}],
        "P1082": [
            {"id": "Q1$CCCCC-1", "rank": "normal", "mainsnak": {"snaktype": "value", "property": "P1082", "datavalue": {"type": "quantity", "value": {"amount": "+12000", "unit": "1"}}}},
            {"id": "Q1$DDDDD-1", "rank": "preferred", "mainsnak": {"snaktype": "value", "property": "P1082", "datavalue": {"type": "quantity", "value": {"amount": "+12345", "unit": "1"}}}},
        ],
        "P625": [{"id": "Q1$EEEEE-1", "rank": "normal", "mainsnak": {"snaktype": "value", "property": "P625", "datavalue": {"type": "globecoordinate", "value": {"latitude": 47.4, "longitude": 15.27}}}}],
    },
}
EMPTY_ITEM = '{"id": "Q9", "type": "item", "labels": [], "descriptions": [], "aliases": [], "sitelinks": [], "claims": []}'


def pages(spark: SparkSession) -> DataFrame:
    return memory(spark, [{"format": "text/x-wiki", "lang": "en"} | p for p in PAGES])


def items(spark: SparkSession) -> DataFrame:
    rows = [dict(page_id=1, title="Q1", source=json.dumps(ITEM, ensure_ascii=False)), dict(page_id=9, title="Q9", source=EMPTY_ITEM), dict(page_id=10, title="Q10", source="{broken")]
    return memory(spark, [{"ns": 0, "revision": 1, "format": "application/json", "lang": "wikidata"} | r for r in rows])

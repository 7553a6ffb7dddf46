import gzip
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citelake import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build(
        "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__ui__enabled="false",
        spark__sql__warehouse__dir="/tmp/citelake-warehouse",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def citation(pmid, version=1, title="A title.", date="<Year>2020</Year><Month>Mar</Month><Day>15</Day>", extra="", ids="", journal="100001", abstract="", authors=""):
    """One citation element."""
    ids = "".join(f'<ArticleId IdType="{t}">{v}</ArticleId>' for t, v in ids) if ids else ""
    return f"""<PubmedArticle><MedlineCitation><PMID Version="{version}">{pmid}</PMID>
<DateRevised><Year>2021</Year><Month>05</Month><Day>02</Day></DateRevised>
<Article><Journal><JournalIssue><Volume>5</Volume><PubDate>{date}</PubDate></JournalIssue></Journal>
<ArticleTitle>{title}</ArticleTitle>{abstract}{authors}{extra}</Article>
<MedlineJournalInfo><NlmUniqueID>{journal}</NlmUniqueID><ISSNLinking>1111-2222</ISSNLinking></MedlineJournalInfo>
<MeshHeadingList><MeshHeading><DescriptorName UI="D1" MajorTopicYN="Y">Things</DescriptorName><QualifierName UI="Q1" MajorTopicYN="N">use</QualifierName></MeshHeading></MeshHeadingList>
</MedlineCitation><PubmedData><History><PubMedPubDate PubStatus="received"><Year>2019</Year><Month>Oct</Month><Day>1</Day></PubMedPubDate></History>
<ArticleIdList><ArticleId IdType="pubmed">{pmid}</ArticleId>{ids}</ArticleIdList>
<ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">10.9/cited</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle>"""


ABSTRACT = """<Abstract><AbstractText Label="BACKGROUND" NlmCategory="BACKGROUND">First <i>part</i>.</AbstractText><AbstractText Label="RESULTS">Second part.</AbstractText></Abstract>"""
AUTHORS = """<AuthorList><Author ValidYN="Y"><LastName>Doe</LastName><ForeName>Ada</ForeName><Identifier Source="ORCID">https://orcid.org/0000-0001-0000-000X</Identifier>
<AffiliationInfo><Affiliation>Lab One.</Affiliation></AffiliationInfo><AffiliationInfo><Affiliation>Lab Two.</Affiliation></AffiliationInfo></Author>
<Author ValidYN="Y"><CollectiveName>The Group</CollectiveName></Author></AuthorList>"""


def release(folder, name, body):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt", encoding="utf-8") as f:
        f.write(f'<?xml version="1.0" encoding="UTF-8"?>\n<PubmedArticleSet>{body}</PubmedArticleSet>')
    return folder / name


@pytest.fixture
def data_dir(tmp_path):
    """A baseline of three records and an update that revises one and deletes another."""
    release(tmp_path / "baseline", "pubmed30n0001.xml.gz", "".join([
        citation(11, title="Old title.", abstract=ABSTRACT, authors=AUTHORS, ids=[("doi", "10.1/a"), ("pmc", "PMC1"), ("pii", "X")]),
        citation(12, date="<Year>2019</Year>"), citation(13, date="<MedlineDate>1998 Spring</MedlineDate>", title="Third.", journal="999"),
    ]))
    release(tmp_path / "updatefiles", "pubmed30n0002.xml.gz", citation(
        11, 2, "New title.", "<Year>2020</Year><Month>03</Month><Day>06</Day>", abstract="<Abstract><AbstractText>Revised.</AbstractText></Abstract>", ids=[("pmc", "PMC2"), ("doi", "10.1/a")],
    ) + "<DeleteCitation><PMID Version='1'>12</PMID></DeleteCitation>")
    rule = "-" * 80
    (tmp_path / "J_Entrez.txt").write_text("\n".join([
        rule, "JrId: 1", "JournalTitle: Journal: One", "MedAbbr: J One", "ISSN (Print): 1111-2222", "ISSN (Online): 3333-4444", "IsoAbbr: J. One", "NlmId: 100001",
        rule, "JrId: 2", "JournalTitle: Two", "MedAbbr: Two", "ISSN (Print):", "IsoAbbr:", "NlmId: 200002", rule, "JrId: 3", "JournalTitle: No id",
        rule, "JrId: 4", "JournalTitle: Again", "ISSN (Print): 9999-9999", "NlmId: 100001",
    ]) + "\n")
    return tmp_path

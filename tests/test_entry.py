"""The driver's entry point with and without the corpus operators."""

import sys

import __spark_entry__ as E
from stockrisk.plans.catalog import QUERIES


def test_queries_without_the_corpus_operators(monkeypatch):
    for name in ("stockrisk.llm", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    assert set(E.queries()) == set(E.oracle_sql()) == set(QUERIES)


def test_a_session_without_a_checkpoint_folder_gets_one():
    class Context:
        master, folder = "local[2]", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    assert E.with_scratch(lambda spark, sf_dir: sf_dir)(Session, "x") == "x"
    assert Session.sparkContext.folder
    Session.sparkContext = Context()
    Session.sparkContext.master = "spark://somewhere"
    E.with_scratch(lambda spark, sf_dir: sf_dir)(Session, "x")
    assert Session.sparkContext.folder is None

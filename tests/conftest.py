import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parent.parent))

from rankloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


# Seven documents with known scores, stemmer off.
CORPUS = [
    (0, "red fox", "the red fox ran past a brown dog", ["wild animal"]),
    (1, "fox red", "a fox and a red hat", ["wild animal"]),
    (2, "blue whale", "big blue whale in the sea", ["sea animal"]),
    (3, "red panda", "red panda eats bamboo", ["wild bear"]),
    (4, "green tea", "hot green tea", ["hot drink"]),
    (5, "black tea", "hot black tea", ["hot drink"]),
    (6, "red fox cub", "red cub", ["young animal"]),
]
DOC_SCHEMA = "doc_id bigint, title string, content string, categories array<string>"
# Node 4 receives only; ranks after convergence are known.
GRAPH = [(0, 1), (0, 2), (1, 2), (2, 0), (3, 2), (3, 4)]
RANKS = {0: 0.331685056, 1: 0.178465770, 2: 0.346099174, 3: 0.0375, 4: 0.0534375}


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(CORPUS, DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def graph(spark):
    return spark.createDataFrame(GRAPH, "src bigint, dst bigint")

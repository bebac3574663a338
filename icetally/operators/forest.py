"""Boosted trees as a column expression: a fitted or stored model scores rows inside whole-stage code.

A forest is plain data (see ``read_forest``): ``{"scale": 2.0, "base": 0.0, "missing": {input: value}, "trees":
[{"weight": w, "root": node}]}``; a node is ``{"value": v}`` or ``{"input": name, "at_most": t | "among": [text, ...],
"yes": node, "no": node}``. The score is 1 / (1 + exp(-scale * (base + sum of weight * leaf))). A missing number takes
the value listed for its input; without one it fails every test, like a category that is not listed.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import ImputerModel, OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: float) -> str:
    return f"double('{float(value)!r}')"


def tree_sql(node: dict, column: str = "{}") -> str:
    """A tree as nested CASE text; ``column`` makes a column name of an input name."""
    if "value" in node:
        return _number(node["value"])
    name = f"`{column.format(node['input'])}`"
    if "at_most" in node:
        test = f"{name} <= {_number(node['at_most'])}"
    else:
        test = f"{name} IN ({', '.join(map(_text, node['among']))})" if node["among"] else "false"
    yes, no = (tree_sql(node[branch], column) for branch in ("yes", "no"))
    return f"CASE WHEN {test} THEN {yes} ELSE {no} END"


def forest_score(forest: dict, column: str = "{}") -> Column:
    """The score of a row whose columns hold the inputs; numbers must be filled (see ``filled``)."""
    margin = " + ".join(
        [_number(forest.get("base", 0.0))]
        + [f"{_number(t.get('weight', 1.0))} * {tree_sql(t['root'], column)}" for t in forest["trees"]])
    return F.expr(f"1 / (1 + exp(-{_number(forest.get('scale', 1.0))} * ({margin})))")


def filled(forest: dict, name: str, value: Column) -> Column:
    """A number with the forest's value in place of null and NaN."""
    known = F.when(~F.isnan(value), value)
    other = forest.get("missing", {}).get(name)
    return known if other is None else F.coalesce(known, F.lit(float(other)))


def inputs_of(forest: dict) -> set[str]:
    """The inputs that any tree asks for."""
    found, left = set(), [t["root"] for t in forest["trees"]]
    while left:
        node = left.pop()
        if "input" in node:
            found.add(node["input"])
            left += [node["yes"], node["no"]]
    return found


def compile_forest(model: PipelineModel) -> dict:
    """The forest of a fitted pipeline of indexers, encoder, imputer, assembler and boosted trees."""
    labels: dict[str, list[str]] = {}
    encoded, renamed, missing = {}, {}, {}
    assembled: list[str] = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            labels[stage.getOutputCol()] = list(stage.labels)
            renamed[stage.getOutputCol()] = stage.getInputCol()
        elif isinstance(stage, OneHotEncoderModel):
            encoded = dict(zip(stage.getOutputCols(), stage.getInputCols()))
        elif isinstance(stage, ImputerModel):
            values = stage.surrogateDF.first().asDict()
            missing = {c: float(v) for c, v in values.items()}
            renamed |= dict(zip(stage.getOutputCols(), stage.getInputCols()))
        elif isinstance(stage, VectorAssembler):
            assembled = stage.getInputCols()
    #: of each place of the feature vector: a number, or a category and the levels that make it 1
    places: list[tuple[str, list[str] | None, bool]] = []
    for c in assembled:
        if c in encoded:
            levels, name = labels[encoded[c]], renamed[encoded[c]]
            places += [(name, [level], True) for level in levels]
            places.append((name, levels, False))  # any other text
        else:
            places.append((renamed.get(c, c), None, True))
    trees = next(s for s in model.stages if isinstance(s, GBTClassificationModel))
    if trees.numFeatures != len(places):
        raise ValueError(f"{trees.numFeatures} features in the model, {len(places)} from its stages")

    def node_of(node) -> dict:
        if node.getClass().getSimpleName() == "LeafNode":
            return {"value": float(node.prediction())}
        split = node.split()
        name, levels, one_if_among = places[split.featureIndex()]
        yes, no = node_of(node.leftChild()), node_of(node.rightChild())
        if split.getClass().getSimpleName() == "ContinuousSplit":
            limit = float(split.threshold())
            if levels is None:
                return {"input": name, "at_most": limit, "yes": yes, "no": no}
            zero_left, one_left = 0.0 <= limit, 1.0 <= limit
        else:
            left = set(split.leftCategories())
            if levels is None:
                raise ValueError(f"{name} is split by categories but not encoded")
            zero_left, one_left = 0.0 in left, 1.0 in left
        one, zero = (yes if one_left else no), (yes if zero_left else no)
        if not one_if_among:
            one, zero = zero, one
        return {"input": name, "among": levels, "yes": one, "no": zero}

    return {
        # the boosted classifier's probability is that of twice its margin
        "scale": 2.0, "base": 0.0, "missing": missing,
        "trees": [{"weight": float(w), "root": node_of(t._java_obj.rootNode())} for w, t in zip(trees.treeWeights, trees.trees)],
    }


def write_forest(spark: SparkSession, forest: dict, path: str) -> None:
    """One JSON text at a path of any store that Spark writes to."""
    spark.createDataFrame([(json.dumps(forest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_forest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first().value)

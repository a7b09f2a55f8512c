"""Nodes of the plan that Spark has executed."""


def _items(seq):
    return [seq.apply(i) for i in range(seq.size())]


def nodes(plan):
    """The plan's nodes with those of its subqueries; a reused exchange or subquery counts as itself only."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    else:
        yield kind, plan
        if not kind.startswith("Reused"):
            for child in _items(plan.children()):
                yield from nodes(child)
            for query in _items(plan.subqueries()):
                yield from nodes(query)


def executed(df):
    """(kind, node) of everything that ran to collect ``df``."""
    df.collect()
    return list(nodes(df._jdf.queryExecution().executedPlan()))


def count(found, part):
    return sum(part in kind for kind, _ in found)


def scans(found):
    """The text of every file scan."""
    return [node.verboseStringWithOperatorId() for kind, node in found if "FileSourceScan" in kind]

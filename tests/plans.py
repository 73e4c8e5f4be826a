"""What the plans of a frame move."""


def carried(df, kind: str) -> list[set[str]]:
    """The columns that each node of a kind in the plan carries."""

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.initialPlan()
        if kind in node.nodeName():
            output = node.output()
            yield {output.apply(i).name() for i in range(output.size())}
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def exchanged(df) -> list[set[str]]:
    return carried(df, "Exchange")

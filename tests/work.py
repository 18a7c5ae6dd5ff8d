"""How many rows the steps of a query make, from Spark's own figures."""


def most_rows(spark, act):
    """What `act` returns, and the most rows that any step of any of its queries has made."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    out = act()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    most, executions = 0, store.executionsList()
    for k in range(before, executions.size()):
        number = executions.apply(k).executionId()
        values = store.executionMetrics(number)
        nodes = store.planGraph(number).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            for metric in (node.metrics().apply(i) for i in range(node.metrics().size())):
                if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                    most = max(most, int(values.apply(metric.accumulatorId()).split()[0].replace(",", "") or 0))
    return out, most

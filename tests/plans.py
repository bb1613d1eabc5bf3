"""Text of physical plans, for tests that look for what a plan does or avoids."""


def plan_of(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )

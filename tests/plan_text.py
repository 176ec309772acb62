"""What plans tell about a query that ran."""


def executed_scans(frame):
    """File scans in the plan that ran; what is reused is not scanned again."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("FileScan ")

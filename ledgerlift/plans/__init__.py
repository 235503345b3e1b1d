from ledgerlift.plans.job import JobResult, run

__all__ = ["JobResult", "run"]

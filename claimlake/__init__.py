"""claimlake: prescription-claims analytics marts as Spark DataFrame jobs."""

from .params import DEFAULT, FIXTURE, Params  # noqa: F401

"""Which failures of a batch its data are to blame for."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PySparkException, PythonException

#: Classes of SQL states (their first two characters) that speak of values, names and types: cardinality, data exceptions, constraints, syntax and names,
#: failed functions, features that a type lacks, and errors that a query raises itself.
DATA_STATES = frozenset({"0A", "21", "22", "23", "38", "39", "42", "P0"})
#: Classes of Java that no data can cause, whatever stands around them.
_MACHINE = ("java.lang.VirtualMachineError", "java.lang.InterruptedException", "java.io.InterruptedIOException")
_DATA_CLASSES = (
    "java.lang.ArithmeticException",
    "java.lang.IllegalArgumentException",
    "java.time.DateTimeException",
    "java.lang.ClassCastException",
    "org.apache.spark.api.python.PythonException",
)


def _causes(error: BaseException) -> Iterator[object]:
    """The Java exceptions behind an error, the outermost first."""
    found = error.java_exception if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
    for _ in range(50):
        if found is None:
            return
        yield found
        found = found.getCause()


def _is(java: object, names: tuple[str, ...]) -> bool:
    kind = java.getClass()
    while kind is not None:
        if kind.getName() in names:
            return True
        kind = kind.getSuperclass()
    return False


def _has_state(java: object) -> bool:
    kind = java.getClass()
    while kind is not None:
        if any(i.getName() == "org.apache.spark.SparkThrowable" for i in kind.getInterfaces()):
            return True
        kind = kind.getSuperclass()
    return False


def is_data_error(error: Exception) -> bool:
    """Whether the same data would fail again: a value, name or type that the job can not bear, or an error of the caller's own code.

    Spark's errors are judged by the SQL states of the whole chain of causes: a failed write task whose cause is a cast is the data's
    fault, one whose cause is a lost executor or a full disk is not. An error of Spark without such a state is not the data's fault, since its
    tasks have been retried before. Python's own errors are, but for those of the operating system, memory and the link to the JVM.
    """
    if isinstance(error, (OSError, MemoryError)):
        return False
    if isinstance(error, PythonException):
        # The caller's function has raised in a worker; a worker that was lost has no such error.
        return True
    if not isinstance(error, (PySparkException, Py4JError)):
        return True
    causes = list(_causes(error))
    if any(_is(cause, _MACHINE) for cause in causes):
        return False
    states = [error.getSqlState()] if isinstance(error, PySparkException) else []
    states += [cause.getSqlState() for cause in causes if _has_state(cause)]
    if any(state and state[:2] in DATA_STATES for state in states):
        return True
    return any(_is(cause, _DATA_CLASSES) for cause in causes)

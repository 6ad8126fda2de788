"""Technical verification of code and math samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve import fixed_values as V
from quillsieve.functions.text import fenced_block, has_any, last_number

METHODS = ("code_execution", "math_validation")


def _result(applicable: Column, correct: Column, message: Column,
            expected: Column | None = None, actual: Column | None = None) -> Column:
    none = F.lit(None).cast("double")
    return F.struct(
        applicable.alias("is_applicable"), correct.alias("is_correct"), message.alias("message"),
        (none if expected is None else expected).alias("expected_answer"),
        (none if actual is None else actual).alias("actual_answer"),
    )


def verify_code(instruction: Column, answer: Column) -> Column:
    """A code task is correct if its answer has a fenced block with content. Code is
    never run."""
    task = F.coalesce(has_any(instruction, V.CODE_TASK_WORDS), F.lit(False))
    found = F.coalesce(fenced_block(answer) != "", F.lit(False))
    message = F.when(~task, V.NOT_CODE).when(found, V.CODE_OK).otherwise(V.NO_CODE)
    return _result(task, ~task | found, message)


def verify_math(instruction: Column, answer: Column, expected: Column | None = None) -> Column:
    """A math task is correct if the last number of the answer equals the expected
    one within 1e-6; either missing means incorrect."""
    task = F.coalesce(has_any(instruction, V.MATH_TASK_WORDS), F.lit(False))
    actual = last_number(answer)
    want = F.lit(None).cast("double") if expected is None else expected
    known = actual.isNotNull() & want.isNotNull()
    equal = F.coalesce(F.abs(want - actual) < 1e-6, F.lit(False))
    message = (
        F.when(~task, V.NOT_MATH).when(~known, V.NO_ANSWER).when(equal, V.MATH_OK).otherwise(V.MATH_BAD)
    )
    return _result(task, ~task | equal, message, F.when(task & known, want), F.when(task & known, actual))


def verify(df: DataFrame, methods: tuple[str, ...] = METHODS, expected: Column | None = None) -> DataFrame:
    """Add the ``verification`` struct: all known methods correct (true without any),
    the method list, and one result per known method. Unknown methods are listed but
    do not count."""
    instruction, answer = F.col("instruction"), F.coalesce(F.col("response.final_answer"), F.lit(""))
    results = {}
    if "code_execution" in methods:
        results["code_execution"] = verify_code(instruction, answer)
    if "math_validation" in methods:
        results["math_validation"] = verify_math(instruction, answer, expected)
    verified = F.lit(True)
    for r in results.values():
        verified = verified & r["is_correct"]
    pairs = [x for name, r in results.items() for x in (F.lit(name), r)]
    kind = ("map<string,struct<is_applicable:boolean,is_correct:boolean,message:string,"
            "expected_answer:double,actual_answer:double>>")
    return df.withColumn("verification", F.struct(
        verified.alias("verified"),
        F.array(*[F.lit(m) for m in methods]).cast("array<string>").alias("methods"),
        (F.create_map(*pairs) if pairs else F.from_json(F.lit("{}"), kind)).alias("results"),
    ))

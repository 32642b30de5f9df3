"""Which files are taken, their language, and their addresses; all plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Extensions taken, and parts of a path that exclude it.
EXTENSIONS = (".ts", ".tsx", ".js", ".jsx", ".java", ".py")
EXCLUDED = ("node_modules/", "dist/", "build/", ".next/", "coverage/", "__generated__/", ".min.js", "__pycache__/", ".venv/", "venv/", "migrations/")
#: Fixed patterns: test files of scripts, and names of Python test files.
SCRIPT_TESTS = r"\.(test|spec)\.[jt]sx?$"
PYTHON_TESTS = r"^test_.*\.py$|_test\.py$"


def is_ingestible(path: Column) -> Column:
    """By extension, excluded parts anywhere in the path (case counts), and test files; null for null."""
    name = F.substring_index(path, "/", -1)
    excluded = F.lit(False)
    for part in EXCLUDED:
        excluded = excluded | path.contains(part)
    extension = F.concat(F.lit("."), F.substring_index(path, ".", -1))
    return path.contains(".") & extension.isin(*EXTENSIONS) & ~excluded & ~path.rlike(SCRIPT_TESTS) & ~name.rlike(PYTHON_TESTS)


def language_for(path: Column) -> Column:
    return F.when(path.endswith(".java"), "java").when(path.endswith(".py"), "python").when(path.endswith(".ts") | path.endswith(".tsx"), "typescript").otherwise("javascript")


def source_id(provider: Column, repo: Column, path: Column) -> Column:
    return F.concat_ws(":", provider, repo, path)


def blob_url(provider: Column, repo: Column, ref: Column, path: Column, gitlab_host: str = "https://gitlab.com") -> Column:
    """Where a file can be seen, by provider; null where a part is null or the provider is another."""
    return (
        F.when(provider == "github", F.concat(F.lit("https://github.com/"), repo, F.lit("/blob/"), ref, F.lit("/"), path))
        .when(provider == "gitlab", F.concat(F.lit(f"{gitlab_host}/"), repo, F.lit("/-/blob/"), ref, F.lit("/"), path))
        .when(provider == "bitbucket", F.concat(F.lit("https://bitbucket.org/"), repo, F.lit("/src/"), ref, F.lit("/"), path))
    )


def with_lines(url: Column, start: Column, end: Column) -> Column:
    """url#Lstart-Lend; null for a null url."""
    return F.concat(url, F.lit("#L"), start.cast("string"), F.lit("-L"), end.cast("string"))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def chunk_id(source: Column, symbol: Column, start_line: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", source, symbol, start_line.cast("string")), 256), 1, 24)


def fq_symbol(repo: Column, path: Column, name: Column) -> Column:
    return F.concat(repo, F.lit(":"), F.coalesce(path, F.lit("")), F.lit(":"), name)


def fq_path(fq: Column) -> Column:
    """What stands between the first and the last colon."""
    first = F.locate(":", fq)
    last = F.length(fq) - F.length(F.substring_index(fq, ":", -1))
    return F.substring(fq, first + 1, F.greatest(last - first - 1, F.lit(0)))


def fq_name(fq: Column) -> Column:
    return F.substring_index(fq, ":", -1)


def snippet(text: Column, most: int = 400) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("\n..."))).otherwise(text)


def joined_parts(*parts: Column) -> Column:
    """Parts that are neither null nor empty, a blank line between them."""
    return F.concat_ws("\n\n", *(F.nullif(p, F.lit("")) for p in parts))

"""Reusable column expressions (all built-in, JVM-side, codegen-friendly)."""

from ledgerloom.functions.exprs import *  # noqa: F401,F403

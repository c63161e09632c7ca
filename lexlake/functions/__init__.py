"""Scalar functions: native column expressions and Arrow functions."""

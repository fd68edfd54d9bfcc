"""Regressors on the feature table: fitted with MLlib, searched on fold moments."""

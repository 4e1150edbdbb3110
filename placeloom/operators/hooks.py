"""User functions per feature that replace the generated result and never stop the job."""
from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType


def feature_hooks(features: DataFrame, hooks: dict[str, Callable[[dict], str]], key: str, default: str) -> DataFrame:
    """`result` is the hook's answer for features whose `key` names a hook, else the `default` column; `hook_error` holds the
    reason when a hook failed and the default was kept. Hooks run in Arrow batches; features without one pass through."""
    schema = StructType(features.schema.fields + [StructField("result", StringType()), StructField("hook_error", StringType())])

    def run(batches):
        for rows in batches:
            results, errors = rows[default].astype(object).tolist(), [None] * len(rows)
            wanted = rows[key].map(lambda k: k in hooks).to_numpy()
            for at in wanted.nonzero()[0]:
                row = rows.iloc[at]
                try:
                    results[at] = str(hooks[row[key]](row.to_dict()))
                except Exception as exc:
                    errors[at] = f"{type(exc).__name__}: {exc}"
            yield rows.assign(result=pd.Series(results, index=rows.index, dtype=object), hook_error=pd.Series(errors, index=rows.index, dtype=object))
    return features.mapInPandas(run, schema)

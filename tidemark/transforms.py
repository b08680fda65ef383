"""The names a transform is written with."""

from tidemark.plans.transforms import (
    Context,
    Input,
    Markings,
    OrgMarkings,
    Output,
    Transform,
    TransformContext,
    TransformInput,
    TransformOutput,
    configure,
    incremental,
    lightweight,
    transform,
    transform_df,
    transform_pandas,
    transform_polars,
)

__all__ = [
    "Context",
    "Input",
    "Markings",
    "OrgMarkings",
    "Output",
    "Transform",
    "TransformContext",
    "TransformInput",
    "TransformOutput",
    "configure",
    "incremental",
    "lightweight",
    "transform",
    "transform_df",
    "transform_pandas",
    "transform_polars",
]

"""The package's scratch folders, by the name that plans use."""

from shoplens.scratch import clear_scratch, scratch_dir, shared_dir, written  # noqa: F401

"""Typed failures of dataset, query and transform calls."""

from __future__ import annotations


class TidemarkError(Exception):
    """Base of all errors raised here."""


class DatasetNotFoundError(TidemarkError):
    pass


class DatasetAlreadyExistsError(TidemarkError):
    pass


class DatasetInTrashError(TidemarkError):
    pass


class BranchNotFoundError(TidemarkError):
    pass


class BranchAlreadyExistsError(TidemarkError):
    pass


class DatasetHasNoSchemaError(TidemarkError):
    pass


class DatasetHasNoTransactionsError(TidemarkError):
    pass


class DatasetHasNoOpenTransactionError(TidemarkError):
    pass


class DatasetHasOpenTransactionError(TidemarkError):
    pass


class DatasetHasNoFilesError(TidemarkError):
    pass


class TransactionNotFoundError(TidemarkError):
    pass


class TransactionTypeMismatchError(TidemarkError):
    def __init__(self, requested: str, opened: str):
        super().__init__(f"requested transaction type {requested}, but the open transaction is {opened}")
        self.requested = requested
        self.opened = opened


class FileAlreadyExistsError(TidemarkError):
    pass


class CommitConflictError(TidemarkError):
    """Another writer committed changes to the same files first."""


class InvalidCacheKeyError(TidemarkError):
    pass


class CacheOutOfSyncError(TidemarkError):
    pass


class QueryFailedError(TidemarkError):
    pass


class QueryTimeoutError(TidemarkError):
    pass


class InputTooLargeError(TidemarkError):
    pass


class UninitializedInputError(TidemarkError):
    def __init__(self, alias: str | None = None):
        super().__init__(f"input {alias!r} was used before a context initialised it")

"""Public errors."""


class LedgerError(Exception):
    """Base of all errors that callers are meant to see."""


class NotFound(LedgerError):
    pass


class AmbiguousIdentifier(LedgerError):
    pass


class AmbiguousAnnulment(LedgerError):
    pass


class InvalidTemporalQuery(LedgerError, ValueError):
    pass


class UnsupportedQuery(LedgerError, ValueError):
    pass


class InvalidCursor(LedgerError, ValueError):
    pass


class UnsupportedCursorVersion(InvalidCursor):
    pass


class CursorDatasetMismatch(InvalidCursor):
    pass

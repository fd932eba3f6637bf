"""tidemark: layered (bronze / silver / gold) warehouse operators for PySpark."""

from tidemark.session import build_session, shared_path, shared_root

__all__ = ["build_session", "shared_path", "shared_root"]

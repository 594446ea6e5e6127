"""Print the registered query names of one registry module (for the checker)."""
import sys, os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from rankforge.registry import all_queries
mod = sys.argv[1]
print(" ".join(n for n, f in all_queries().items() if f.__module__.endswith(mod)))

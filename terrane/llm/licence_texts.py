"""Known licence texts and notices, and spellings that count as one. The long texts are files of the folder ``known``."""

import pkgutil

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""

_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

_BULLETS = str.maketrans("", "", "123")  # lists with '*' or '-' in place of numbers


def _file(name: str) -> str:
    return (pkgutil.get_data(__package__, f"known/{name}.txt") or b"").decode()


def _forms(name: str) -> list[str]:
    """A bundled file, and its usual shorter forms: without what follows the terms, without its title."""
    text = _file(name)
    found = [text]
    if "END OF TERMS AND CONDITIONS" in text:
        found.append(text[: text.index("END OF TERMS AND CONDITIONS")])
        found.append(found[-1] + "END OF TERMS AND CONDITIONS")
    if "Exhibit B - " in text:
        found += [text[: text.index("Exhibit B - ")], text[: text.index("Exhibit A - ")]]
    if name == "BSL-1.0":
        found.append(text[text.index("Permission") :])
    if name == "Unlicense":
        found += [f"The Unlicense\n\n{text}", f"Unlicense\n\n{text}"]
    return found


_FILES = (
    "Apache-2.0", "Artistic-1.0-Perl", "BSL-1.0", "CC-BY-SA-4.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0",
    "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0", "Unlicense", "WTFPL",
)
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
_CC = {
    "CC-BY": "Attribution", "CC-BY-SA": "Attribution-ShareAlike", "CC-BY-NC": "Attribution-NonCommercial", "CC-BY-ND": "Attribution-NoDerivatives",
    "CC-BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "CC-BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
# What notices and SPDX lines call a licence.
_NAMES = {
    "MIT": ["MIT License", "MIT", "Expat License"], "ISC": ["ISC License", "ISC"], "Zlib": ["zlib License", "Zlib"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause License", "New BSD License", "Modified BSD License", "BSD-3-Clause"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0", "Apache-2.0", "Apache Software License 2.0"],
    "MPL-1.1": ["Mozilla Public License, Version 1.1", "MPL 1.1"], "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"], "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, Version 2.0"],
    "Unlicense": ["Unlicense"], "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"], "WTFPL": ["WTFPL"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
}
for _id, _name in _CC.items():
    for _v in ("3.0", "4.0"):
        _of = "International" if _v == "4.0" else "Unported"
        _NAMES[f"{_id}-{_v}"] = [
            f"{_id[:2]} {_id[3:]} {_v}", f"{_id}-{_v}", f"Creative Commons {_name} {_v} License", f"Creative Commons {_name} {_v} {_of} License", f"Creative Commons {_name} {_v} {_of}",
        ]
for _id, _versions in {"GPL": ("1.0", "2.0", "3.0"), "LGPL": ("2.0", "2.1", "3.0"), "AGPL": ("3.0",)}.items():
    for _v in _versions:
        _short = _v.removesuffix(".0")
        _said = [f"{_GNU[_id]}, version {_short}", f"{_GNU[_id]} version {_short}", f"{_GNU[_id]} v{_short}", f"{_GNU[_id]} v{_v}", f"{_id}v{_short}", f"{_id} v{_short}", f"{_id}-{_v}"]
        _NAMES[f"{_id}-{_v}"] = _said
        _NAMES[f"{_id}-{_v}-only"] = [f"{x} only" for x in _said]
        _NAMES[f"{_id}-{_v}-or-later"] = [f"{x}{y}" for x in _said for y in (" or later", " or any later version", ", or (at your option) any later version")]
_SAYS = [
    "Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under", "This project is licensed under",
    "This software is licensed under", "This software is released under", "This file is licensed under", "This program is licensed under",
    "This code is licensed under", "This library is licensed under", "This repository is licensed under", "This package is licensed under",
]
_SPDX = [*_NAMES, *(x for x in _FILES if x not in _NAMES)]

#: Fixed values: (licence, text).
KNOWN = [
    ("MIT", _MIT),
    ("MIT", f"The MIT License (MIT)\n\n{_MIT}"),
    ("MIT", f"MIT License\n\n{_MIT}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC),
    ("ISC", f"ISC License\n\n{_ISC}"),
    ("BSD-2-Clause", f"{_BSD_START}\n\n{_BSD_END}"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD_START}\n\n{_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_START}\n\n{_BSD_NAMES}\n\n{_BSD_END}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD_START}\n\n{_BSD_NAMES}\n\n{_BSD_END}"),
    ("Zlib", _ZLIB),
    ("Zlib", f"zlib License\n\n{_ZLIB}"),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    *(("BSD-2-Clause", x + f"{_BSD_START}\n\n{_BSD_END}".translate(_BULLETS)) for x in ("", "BSD 2-Clause License\n\n")),
    *(("BSD-3-Clause", x + f"{_BSD_START}\n\n{_BSD_NAMES}\n\n{_BSD_END}".translate(_BULLETS)) for x in ("", "BSD 3-Clause License\n\n")),
    *((name, text) for name in _FILES for text in _forms(name)),
    *((name, f"{say} {the}{said}.") for name, names in _NAMES.items() for said in names for say in _SAYS for the in ("", "the ", "a ")),
    *((name, f"SPDX-License-Identifier: {name}") for name in _SPDX),
    *((name, f"License: {name}") for name in _SPDX),
]

#: Words that open a licence or a notice, so that a claim of copyright before them ends.
OPENINGS = (
    "permission is hereby granted", "permission to use", "permission is granted", "permission is freely granted", "redistribution and use",
    "redistribution of", "licensed under", "released under", "distributed under", "available under", "this work is licensed", "this software is",
    "this program is", "this program comes", "this library is", "this file is", "this source code", "this is free", "the software is", "use of this source",
    "everyone is permitted", "spdx license identifier", "spdx-license-identifier", "preamble", "gnomovision comes",
)

#: Words that are written in several ways, and the one that stands for them.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "acknowledgements": "acknowledgments", "analogue": "analog", "analyse": "analyze",
    "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber",
    "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize",
    "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "https": "http", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licences": "licenses", "licenced": "licensed", "maximise": "maximize",
    "merchantibility": "merchantability", "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

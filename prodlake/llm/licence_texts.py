"""Licence templates: label, notice, mandatory key phrase, which stands in the notice.

Notices as licences ask for them at the head of a file, short forms that name a licence, and the opening
or the terms of licences that are whole notices themselves. Fixed values, in natural order; a caller may
pass any other list.
"""

from __future__ import annotations

_WARRANTY = (
    "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability,"
    " fitness for a particular purpose and noninfringement."
)
_BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"
    " and/or other materials provided with the distribution."
)
_FREE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
_HOPE = (
    "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or"
    " fitness for a particular purpose."
)

TEMPLATES = [
    ("apache-2.0", "licensed under the Apache License, Version 2.0", "apache license version 2"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy"
        " of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under"
        " the License is distributed on an as is basis, without warranties or conditions of any kind, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License.",
        "you may not use this file except in compliance with the license",
    ),
    ("apache-1.1", "This product includes software developed by the Apache Software Foundation", "developed by the apache software foundation"),
    ("mit", "released under the MIT License", "mit license"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to"
        " deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY,
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ),
    (
        "mit-0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the"
        " Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so. " + _WARRANTY,
        "to whom the software is furnished to do so the software is provided as is",
    ),
    ("gpl-3.0", "licensed under the GNU General Public License version 3", "general public license version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License version 2", "general public license version 2"),
    (
        "gpl-3.0",
        f"{_FREE} General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. {_HOPE}",
        "gnu general public license as published by the free software foundation either version 3 of the license",
    ),
    (
        "gpl-2.0",
        f"{_FREE} General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. {_HOPE}",
        "gnu general public license as published by the free software foundation either version 2 of the license",
    ),
    ("lgpl", "licensed under the GNU Lesser General Public License", "lesser general public license"),
    (
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the"
        " Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "lesser general public license as published by the free software foundation either version 2 1",
    ),
    (
        "lgpl-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the"
        " Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "lesser general public license as published by the free software foundation either version 3",
    ),
    ("agpl", "licensed under the GNU Affero General Public License", "affero general public license"),
    (
        "agpl-3.0",
        f"{_FREE} Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "affero general public license as published by the free software foundation either version 3",
    ),
    (
        "gfdl-1.3",
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later"
        " version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts.",
        "gnu free documentation license",
    ),
    ("cc-by-nc", "licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-nd", "licensed under CC BY-ND 4.0", "cc by nd"),
    ("creative-commons", "licensed under a Creative Commons Attribution License", "creative commons"),
    (
        "cc-by-4.0",
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit"
        " http://creativecommons.org/licenses/by/4.0/",
        "creative commons attribution 4 0 international license",
    ),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "attribution sharealike 4 0 international"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "attribution noncommercial 4 0 international"),
    ("cc-by-nd-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "attribution noderivatives 4 0 international"),
    (
        "cc0-1.0",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
        "to the extent possible under law",
    ),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "source and binary forms"),
    ("bsd", "released under the BSD license", "bsd license"),
    ("bsd-2-clause", _BSD_CLAUSES, "redistributions in binary form must reproduce the above copyright notice"),
    (
        "bsd-3-clause",
        _BSD_CLAUSES
        + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without"
        " specific prior written permission.",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    (
        "bsd-4-clause",
        "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by",
        "all advertising materials mentioning features or use of this software",
    ),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can"
        " obtain one at http://mozilla.org/MPL/2.0/.",
        "this source code form is subject to the terms of the mozilla public license",
    ),
    (
        "mpl-1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License.",
        "mozilla public license version 1 1",
    ),
    ("isc", "released under the ISC license", "isc license"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright"
        " notice and this permission notice appear in all copies.",
        "for any purpose with or without fee is hereby granted",
    ),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. The software is provided as is", "with or without fee is hereby granted the software is provided as is"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered software"),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this"
        " software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "anyone is free to copy modify publish use compile sell or distribute this software",
    ),
    (
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of"
        " this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it"
        " freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "the origin of this software must not be misrepresented",
    ),
    (
        "bsl-1.0",
        "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt",
        "boost software license version 1 0",
    ),
    (
        "epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "eclipse public license 2 0",
    ),
    (
        "epl-1.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution",
        "eclipse public license v1 0",
    ),
    (
        "cddl-1.0",
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the License). You may not use this file except in"
        " compliance with the License.",
        "common development and distribution license",
    ),
    ("eupl-1.2", "Licensed under the European Union Public Licence, Version 1.2 or as soon they will be approved by the European Commission subsequent versions of the EUPL", "european union public licence"),
    ("artistic-2.0", "This is free software, licensed under the Artistic License 2.0", "artistic license 2 0"),
    ("psf-2.0", "This LICENSE AGREEMENT is between the Python Software Foundation and the Individual or Organization accessing and otherwise using this software", "agreement is between the python software foundation"),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed", "changing it is allowed as long as the name is changed"),
    ("ofl-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1", "sil open font license"),
    ("ncsa", "Permission is hereby granted to deal with the Software without restriction. University of Illinois/NCSA Open Source License", "ncsa open source license"),
    ("upl-1.0", "The Universal Permissive License (UPL), Version 1.0", "universal permissive license"),
    ("ms-pl", "This license governs use of the accompanying software. Microsoft Public License (Ms-PL)", "microsoft public license"),
    ("ms-rl", "This license governs use of the accompanying software. Microsoft Reciprocal License (Ms-RL)", "microsoft reciprocal license"),
    ("openssl", "This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit", "developed by the openssl project"),
    ("postgresql", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted", "without a written agreement is hereby granted"),
    ("beerware", "As long as you retain this notice you can do whatever you want with this stuff. If we meet some day, and you think this stuff is worth it, you can buy me a beer in return", "you can buy me a beer in return"),
    ("odbl-1.0", "is made available under the Open Database License: http://opendatacommons.org/licenses/odbl/1.0/", "open database license"),
    ("sspl-1.0", "you can redistribute it and/or modify it under the terms of the Server Side Public License, version 1, as published by MongoDB", "server side public license"),
    ("busl-1.1", "Use of this software is governed by the Business Source License included in the LICENSE file", "business source license"),
    ("proprietary", "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited", "proprietary and confidential"),
]
